"""Source profile, rows and columns per source, as one DataFrame."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def profile_sources(sources: dict[str, DataFrame]) -> DataFrame:
    """(source, row_count, column_count) for every source, in one job.

    Counts over parquet are answered from footers; over CSV each file is read
    once, all of them in the same job through the union.
    """
    parts = [df.agg(F.count(F.lit(1)).cast("long").alias("row_count"))
               .select(F.lit(name).alias("source"), "row_count",
                       F.lit(len(df.columns)).cast("int").alias("column_count"))
             for name, df in sources.items()]
    return reduce(DataFrame.unionByName, parts)
