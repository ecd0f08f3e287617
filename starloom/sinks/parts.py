"""Facts in day parts, of which a refresh writes only what changed (K4).

A part is the rows of one day (of a fact's own date column; rows without a date
are a part too, and a fact without a date column is one part).  Its digest --
row count, and two independent sums of 64-bit row hashes -- does not depend on
the order of rows or their distribution over files.  A refresh takes the digests
of the new fact in one aggregate that is combined map-side (a row per day leaves
a task, a row per day reaches the driver), compares them with those in the
published manifest, writes the days that differ into its own run folder, and
names the folders of all other days as they are.  The published tables are not
read, and no published file is touched.

The rows of the changed days are built again for the write; the filter on the
day reaches the source's scan where the day is a function of a source column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.plans.observed import MAY_BE_UNKNOWN, NOT_NULL
from starloom.sinks.versions import Manifest, TableEntry, Versions

#: The date a fact is cut by: a ``yyyymmdd`` key column of the fact itself.
PART_COLUMNS = {"fact_orders": "purchase_date_id", "fact_order_items": "shipping_limit_date_id",
                "fact_reviews": "creation_date_id"}
_PART = "__sl_part"
NO_DATE, WHOLE = "none", "all"


def part_of(column: str | None):
    return F.lit(WHOLE) if column is None else F.coalesce(F.col(column).cast("string"), F.lit(NO_DATE))


def part_digests(df: DataFrame, name: str, column: str | None, unknown: int = 0) -> DataFrame:
    """A row per part: rows, digest and the counts of the checks, in one aggregate."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    # a null and its neighbour's value must not hash alike: nulls are hashed by place
    nulls = F.concat(*[F.when(c.isNull(), F.lit("1")).otherwise(F.lit("0")) for c in cols])
    total = lambda h: F.sum(h.cast("decimal(38,0)")).cast("string")
    metrics = {f"null {c}": F.count_if(F.col(c).isNull()) for c in NOT_NULL.get(name, ())}
    metrics |= {f"unknown {c}": F.count_if(F.col(c) == unknown) for c in MAY_BE_UNKNOWN.get(name, ())}
    out = (df.groupBy(part_of(column).alias("part"))
           .agg(F.count(F.lit(1)).alias("rows"), total(F.xxhash64(*cols, nulls)).alias("a"),
                total(F.xxhash64(F.lit(name), nulls, *reversed(cols))).alias("b"),
                *[m.alias(k) for k, m in metrics.items()]))
    return out.select("part", "rows", F.concat_ws(":", F.col("rows").cast("string"), "a", "b").alias("digest"),
                      *[F.col(f"`{k}`") for k in metrics])


def changed_parts(old: DataFrame, new: DataFrame, name: str, column: str | None) -> DataFrame:
    """The parts in which two states of a fact differ: part, change (new, gone
    or changed), old_rows, new_rows."""
    a = part_digests(old, name, column).select("part", F.col("rows").alias("old_rows"), F.col("digest").alias("a"))
    b = part_digests(new, name, column).select("part", F.col("rows").alias("new_rows"), F.col("digest").alias("b"))
    change = F.when(F.col("a").isNull(), "new").when(F.col("b").isNull(), "gone").otherwise("changed")
    return (a.join(b, "part", "full").where(~F.col("a").eqNullSafe(F.col("b")))
            .select("part", change.alias("change"), F.coalesce("old_rows", F.lit(0)).alias("old_rows"),
                    F.coalesce("new_rows", F.lit(0)).alias("new_rows")))


def write_parts(versions: Versions, df: DataFrame, name: str, column: str | None,
                base: Manifest | None, run: str) -> TableEntry:
    """Write the parts of ``df`` that differ from ``base``; the entry of the
    new version names those and the unchanged folders of earlier runs."""
    old = base.tables.get(name) if base else None
    schema = df.schema.jsonValue()
    same = old is not None and old.parts is not None and old.part_by == column and old.schema == schema
    known = old.parts if same else {}
    found = {r.pop("part"): r for r in (row.asDict() for row in part_digests(df, name, column).collect())}
    changed = sorted(p for p, d in found.items() if known.get(p, {}).get("digest") != d["digest"])
    folder = f"{run}/{name}"
    if changed:
        rows = df if len(changed) == len(found) else df.where(_in_parts(column, changed))
        rows = rows.withColumn(_PART, part_of(column))
        if column is not None:
            # a day's rows meet in few files; adaptive execution splits a hot day and joins small ones
            rows = rows.hint("rebalance", F.col(_PART))
        rows.write.mode("errorifexists").partitionBy(_PART).parquet(versions.path(folder))
    parts = {}
    for p, d in found.items():
        where = f"{folder}/{_PART}={p}" if p in set(changed) else known[p]["folder"]
        parts[p] = {**d, "folder": where}
    metrics: dict[str, int] = {"rows": 0}
    for d in found.values():
        for k, v in d.items():
            if k != "digest":
                metrics[k] = metrics.get(k, 0) + int(v)
    return TableEntry([d["folder"] for d in parts.values()], schema, "parquet", metrics, parts, column)


def _in_parts(column: str | None, parts: list[str]):
    if column is None:
        return F.lit(True)
    days = [int(p) for p in parts if p != NO_DATE]
    chosen = F.col(column).isin(days) if days else F.lit(False)
    return (chosen | F.col(column).isNull()) if NO_DATE in parts else chosen
