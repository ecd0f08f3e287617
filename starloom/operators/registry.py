"""Surrogate keys that outlive their members (X3 across refreshes).

A registry has a row per member a dimension ever had: natural key, surrogate
key, and whether the member is retired (absent from the last refresh).  New
members are numbered after the highest key ever given, the registry's maximum,
so the key of a retired member is never given to another; a member that comes
back gets its old key.  Natural keys are matched null-safe: the null member, if
there is one, keeps its key too.

Each refresh is one join of the members with the narrow registry (hash
partitioned on the natural key, split by adaptive execution where skewed) and a
dense numbering of the new members only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.keys import _names, dense_key
from starloom.operators.lookups import known_rows, known_top, remember_rows, remember_top

RETIRED = "retired"


def as_registry(keyed: DataFrame, natural_key, key_name: str) -> DataFrame:
    """The registry of a dimension that has none yet: all members, none retired."""
    out = keyed.select(*_names(natural_key), F.col(key_name).cast("long").alias(key_name))
    return remember_rows(out.withColumn(RETIRED, F.lit(False)), known_rows(keyed))


def high_water(registry: DataFrame, key_name: str) -> int:
    """The highest key ever given: one number, read from one narrow column."""
    return int(registry.agg(F.coalesce(F.max(key_name), F.lit(0))).first()[0])


def registered_keys(members: DataFrame, registry: DataFrame, natural_key, key_name: str,
                    num_buckets: int | None = None) -> DataFrame:
    """``members`` (one row per natural key) with ``key_name``: the registered
    key of those met before, retired or not, and new keys, in natural-key
    order, after the high-water mark for the others."""
    keys = _names(natural_key)
    known = registry.select(*[F.col(k).alias("__sl_k_" + k) for k in keys], F.col(key_name).cast("long").alias(key_name))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col("__sl_k_" + k)) for k in keys])
    met = members.join(known, same, "inner").select(*members.columns, key_name)
    fresh = dense_key(members.join(known, same, "left_anti"), keys, key_name, num_buckets=num_buckets,
                      first=high_water(registry, key_name) + 1)
    return remember_top(met.unionByName(fresh), known_top(fresh))


def next_registry(registry: DataFrame | None, keyed: DataFrame, natural_key, key_name: str) -> DataFrame:
    """The registry after a refresh whose dimension is ``keyed``."""
    now = as_registry(keyed, natural_key, key_name)
    if registry is None:
        return now
    gone = registry.join(now.select(key_name), key_name, "left_anti").withColumn(RETIRED, F.lit(True))
    return now.unionByName(gone.select(*now.columns))
