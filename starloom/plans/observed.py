"""Counts that a write takes on its way.

Every table of a build carries an ``Observation``: rows, null keys and rows of
the unknown member are counted by the job that writes the table, and a fact's
source is counted by the job that reads it for the fact.  Nothing is scanned
again for these checks.

A source is counted below the fact's joins.  If those shuffle and an executor
is lost, tasks run again and may count twice, so a mismatch is confirmed by a
plain count of the source before it is reported.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fact -> source whose rows it keeps.
FACT_SOURCES = {"fact_orders": "orders", "fact_order_items": "order_items",
                "fact_payments": "order_payments", "fact_reviews": "order_reviews"}
#: Keys that should not be null, and keys that may be the unknown member.
NOT_NULL = {"fact_orders": ("customer_sk", "purchase_date_id"), "fact_payments": ("payment_sk",),
            "fact_order_items": ("product_sk", "seller_sk")}
MAY_BE_UNKNOWN = {"fact_order_items": ("product_sk", "seller_sk")}

CHECK_SCHEMA = T.StructType([T.StructField("check", T.StringType()), T.StructField("subject", T.StringType()),
                             T.StructField("observed", T.LongType()), T.StructField("expected", T.LongType()),
                             T.StructField("passed", T.BooleanType())])


#: Seconds to wait for the metrics of a finished job.
REPORTED_WITHIN = 60


def taken(seen: Observation) -> dict[str, int] | None:
    """The metrics of a finished job, or None: a plan that turns out empty may
    drop the step that counts, and its observation then never reports."""
    got: list[dict] = []
    wait = threading.Thread(target=lambda: got.append(seen.get), daemon=True)
    wait.start()
    wait.join(REPORTED_WITHIN)
    return {k: int(v) for k, v in got[0].items()} if got else None


class Watch:
    """Observations of one build."""

    def __init__(self, sources: dict[str, DataFrame], unknown_key: int = 0):
        self.sources, self.unknown = sources, unknown_key
        self._tables: dict[str, Observation] = {}
        self._read: dict[str, Observation] = {}

    def fact_sources(self, fact: str) -> dict[str, DataFrame]:
        """The sources, with the one that ``fact`` keeps the rows of counted as it is read."""
        name = FACT_SOURCES.get(fact)
        if name is None or name not in self.sources:
            return self.sources
        self._read[fact] = Observation()
        return {**self.sources, name: self.sources[name].observe(self._read[fact], F.count(F.lit(1)).alias("rows"))}

    def table(self, name: str, df: DataFrame) -> DataFrame:
        """``df``, to be written once, with its counts taken by that job."""
        self._tables[name] = Observation()
        metrics = [F.count(F.lit(1)).alias("rows")]
        metrics += [F.count_if(F.col(c).isNull()).alias(f"null {c}") for c in NOT_NULL.get(name, ())]
        metrics += [F.count_if(F.col(c) == self.unknown).alias(f"unknown {c}") for c in MAY_BE_UNKNOWN.get(name, ())]
        return df.observe(self._tables[name], *metrics)

    def metrics(self, name: str) -> dict[str, int]:
        """What the write of a table counted; empty if it was not watched."""
        found = taken(self._tables[name]) if name in self._tables else None
        return found or {}

    def source_rows(self, metrics: dict[str, dict[str, int]]) -> dict[str, int]:
        """Rows of each watched fact's source; counted anew where they differ
        from the fact's, or were not reported."""
        out = {}
        for fact, seen in self._read.items():
            if fact in metrics:
                n = (taken(seen) or {}).get("rows")
                out[fact] = n if n == metrics[fact]["rows"] else self.sources[FACT_SOURCES[fact]].count()
        return out


def observed_checks(metrics: dict[str, dict[str, int]], read_rows: dict[str, int]) -> list[tuple]:
    """V1 and V2 as check rows, from what the writes counted."""
    rows = [("row_count", fact, metrics[fact]["rows"], read_rows[fact]) for fact in FACT_SOURCES if fact in read_rows]
    for table, found in metrics.items():
        for what, n in found.items():
            kind, _, column = what.partition(" ")
            if column:
                rows.append((f"{kind}_key", f"{table}.{column}", n, 0))
    return [(*r, r[2] == r[3]) for r in rows]


def check_frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, CHECK_SCHEMA)
