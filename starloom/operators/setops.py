"""Column stacking and key-set differences."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stack_columns(df: DataFrame, cols, name: str = "value") -> DataFrame:
    """All values of ``cols`` as one column, one scan of ``df``."""
    return df.select(F.explode(F.array(*[F.col(c) for c in cols])).alias(name))


def missing_keys(left: DataFrame, right: DataFrame, left_key: str,
                 right_key: str | None = None) -> DataFrame:
    """Distinct non-null ``left_key`` values absent from ``right``.

    Null keys are not "missing"; count them with ``null_count`` (D8).
    Both sides are cut to distinct keys, combined map-side, before the anti
    join, so a key holding a third of either side reaches the join once; the
    distinct leaves each side hash-partitioned on the key, which the join
    reuses without another exchange.
    """
    right_key = right_key or left_key
    a = left.select(F.col(left_key).alias("__sl_k")).where(F.col("__sl_k").isNotNull()).distinct()
    b = right.select(F.col(right_key).alias("__sl_k")).where(F.col("__sl_k").isNotNull()).distinct()
    return a.join(b, "__sl_k", "left_anti").withColumnRenamed("__sl_k", left_key)


def anti_rows(left: DataFrame, right: DataFrame, left_key: str,
              right_key: str | None = None) -> DataFrame:
    """Rows of ``left`` with no partner in ``right`` (the
    ``LEFT JOIN ... WHERE right.key IS NULL`` form; null left keys survive).
    The right side is reduced to its distinct keys (combined map-side) first."""
    right_key = right_key or left_key
    b = (right.select(F.col(right_key).alias("__sl_rk")).where(F.col("__sl_rk").isNotNull())
              .distinct())
    return left.join(b, F.col(left_key) == F.col("__sl_rk"), "left_anti")
