"""Members a dimension gets from its facts.

Facts may use a natural key before, or without, the row that describes it.  An
inferred member stands in for it: the key, no attributes, and a flag.  It takes a
surrogate key like any member; when the real row comes, the same natural key
meets the same key in the registry, and the attributes are filled in place.
Uses without any key meet the unknown member, key 0.  With both, inner joins of
facts to the dimension lose no row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.lookups import known_rows, remember_rows

INFERRED = "is_inferred"


def _blank(keys: DataFrame, like: DataFrame, given: dict) -> DataFrame:
    return keys.select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in like.schema.fields])


def with_inferred(members: DataFrame, natural_key: str, used: list[DataFrame]) -> DataFrame:
    """``members`` (one row per key) flagged false, and a flagged row for every
    key of ``used`` (frames of one column) that they lack.  Keys are cut to
    distinct ones, combined map-side, before they meet the members."""
    members = members.withColumn(INFERRED, F.lit(False))
    keys = reduce(DataFrame.union, [u.toDF("__sl_k") for u in used]).where(F.col("__sl_k").isNotNull()).distinct()
    known = members.select(F.col(natural_key).alias("__sl_k")).where(F.col("__sl_k").isNotNull())
    missing = keys.join(known, "__sl_k", "left_anti")
    return members.unionByName(_blank(missing, members, {natural_key: F.col("__sl_k"), INFERRED: F.lit(True)}))


def with_unknown(dim: DataFrame, key_name: str, unknown: int = 0) -> DataFrame:
    """``dim`` and its unknown member: key ``unknown``, nothing else known."""
    row = _blank(dim.sparkSession.range(1), dim, {key_name: F.lit(unknown), INFERRED: F.lit(True)})
    n = known_rows(dim)
    return remember_rows(dim.unionByName(row), None if n is None else n + 1)
