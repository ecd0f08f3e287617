"""Both sides of many keys at once.

Every question a check asks about a key -- rows, nulls, duplicates, distinct
values, values the other side lacks, in both directions -- is answered by one
aggregate over the tagged union of all sides: a row per (family, key) with how
often the key occurs on each side.  A table is scanned once however many of its
columns take part, rows are combined map-side, and only distinct keys are
shuffled, so a key that holds a third of a fact counts once a task.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The two sides of a family: where keys come from, and where they are used.
HOME, USE = 0, 1


@dataclass(frozen=True)
class Side:
    """A key column of a table on one side of a family.  ``key`` None counts
    rows only."""

    family: str
    side: int
    table: str
    key: Column | None = None


def key_sides(tables: dict[str, DataFrame], sides: list[Side]) -> DataFrame:
    """(family, key, home, used): occurrences of every key on both sides; keys
    are compared as text, a null key is a row of its own."""
    parts = []
    for name in dict.fromkeys(s.table for s in sides):
        tags = [F.struct(F.lit(s.family).alias("family"), F.lit(s.side).alias("side"),
                         (F.lit(None) if s.key is None else s.key).cast("string").alias("key"))
                for s in sides if s.table == name]
        parts.append(tables[name].select(F.explode(F.array(*tags)).alias("t")).select("t.*"))
    # a row on neither side for every family: an empty one has zeros, not no row
    families = F.array(*[F.lit(f) for f in dict.fromkeys(s.family for s in sides)])
    none = parts[0].sparkSession.range(1).select(F.explode(families).alias("family"), F.lit(-1).alias("side"),
                                                 F.lit(None).cast("string").alias("key"))
    return (reduce(DataFrame.unionByName, [none, *parts]).groupBy("family", "key")
            .agg(F.count_if(F.col("side") == HOME).alias("home"), F.count_if(F.col("side") == USE).alias("used")))


def reconcile(tables: dict[str, DataFrame], sides: list[Side], unknown: str = "0") -> DataFrame:
    """One row per family: rows, nulls, distinct keys and repeated keys of both
    sides; ``orphans`` (keys used, not at home), ``unused`` (at home, not used),
    ``shared``, and ``unknown_rows`` (uses of the unknown member)."""
    has, home, used = F.col("key").isNotNull(), F.col("home"), F.col("used")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return key_sides(tables, sides).groupBy("family").agg(
        total(home).alias("home_rows"), total(F.when(~has, home)).alias("home_nulls"),
        F.count_if(has & (home > 0)).alias("home_keys"), F.count_if(has & (home > 1)).alias("home_repeated"),
        total(used).alias("used_rows"), total(F.when(~has, used)).alias("used_nulls"),
        F.count_if(has & (used > 0)).alias("used_keys"),
        F.count_if(has & (used > 0) & (home == 0)).alias("orphans"),
        F.count_if(has & (home > 0) & (used == 0)).alias("unused"),
        F.count_if(has & (home > 0) & (used > 0)).alias("shared"),
        total(F.when(F.col("key") == unknown, used)).alias("unknown_rows"))
