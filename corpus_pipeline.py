"""The corpus pipeline: toxicity, near duplicates, decontamination, mixing, sharding.

Each stage works on all rows its predecessor kept, and its decisions take
effect; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import decontaminate, entropy_mix, ngram_jaccard, sharding, toxicity
from starloom.llm.common import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below 0.7."""
    model = toxicity.trained(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where(F.col("score") < 0.7).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component."""
    return ngram_jaccard.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that match no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as many times as the mix takes them."""
    return entropy_mix.repeated(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard."""
    return sharding.place(docs)


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates),
          ("decontamination", drop_contaminated), ("mixing", mix_sources), ("sharding", shard)]

#: A trained classifier is no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
