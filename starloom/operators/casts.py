"""Checked narrowing casts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.lookups import known_top

_RANGES = {"int": (-2**31, 2**31 - 1), "smallint": (-2**15, 2**15 - 1),
           "tinyint": (-2**7, 2**7 - 1), "bigint": (-2**63, 2**63 - 1)}


def downcast_report(df: DataFrame, cols, to: str = "int") -> DataFrame:
    """One pass over ``df``: per column, rows, nulls, and values out of range
    for ``to``.  Columns: column, row_count, null_count, overflow_count, castable.
    """
    lo, hi = _RANGES[to]
    aggs = [F.count(F.lit(1)).alias("row_count")]
    for c in cols:
        v = F.col(c)
        aggs += [F.count_if(v.isNull()).alias(f"{c}__nulls"),
                 F.count_if(v.isNotNull() & ((v < F.lit(lo)) | (v > F.lit(hi)))).alias(f"{c}__over")]
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"), F.col("row_count").alias("row_count"),
                     F.col(f"{c}__nulls").alias("null_count"),
                     F.col(f"{c}__over").alias("overflow_count")) for c in cols]
    out = one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return out.withColumn("castable", (F.col("null_count") == 0) & (F.col("overflow_count") == 0))


def checked(value: Column, to: str, name: str = "value") -> Column:
    """``value`` as ``to``; out of range it raises, whatever the ANSI setting."""
    lo, hi = _RANGES[to]
    return F.when(value.isNull() | value.between(F.lit(lo), F.lit(hi)), value.cast(to)).otherwise(
        F.raise_error(F.concat(F.lit(f"{name} is out of range for {to}: "), value.cast("string"))).cast(to))


def downcast(df: DataFrame, cols, to: str = "int", on_overflow: str = "error") -> DataFrame:
    """Cast ``cols`` to ``to``.  Nulls stay null (Spark ints are nullable, so
    no column is skipped).  ``on_overflow="error"`` fails the job, with ANSI
    on or off; ``"null"`` turns out-of-range values into null; ``"widen"``
    profiles the columns in one pass first and leaves those that do not fit."""
    if on_overflow == "null":
        return df.withColumns({c: F.col(c).try_cast(to) for c in cols})
    if on_overflow == "widen":
        wide = {r["column"] for r in downcast_report(df, cols, to).collect() if r["overflow_count"]}
        cols = [c for c in cols if c not in wide]
    return df.withColumns({c: checked(F.col(c), to, c) for c in cols}) if cols else df


def narrow_key(df: DataFrame, key_name: str, to: str = "int") -> Column:
    """The surrogate key as ``to`` where it is proven to fit, by the highest key
    the numbering gave; as long where it is proven not to; checked row by row
    where nothing is known."""
    top = known_top(df)
    if top is None:
        return checked(F.col(key_name), to, key_name).alias(key_name)
    return F.col(key_name).cast(to if top <= _RANGES[to][1] else "bigint").alias(key_name)
