"""Small helpers the operators share: tables written in the shared folder,
word rule, null-safe selection."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import ensure_checkpoint_dir

#: Words are runs of anything but blank and the ASCII controls tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, what: str = "step", partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read
    it back.  Cuts the lineage: what follows survives a lost executor without
    recomputing what came before, and columns are pruned when it is read."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/starloom-llm/{what}-{uuid.uuid4().hex}"
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """The tables of one call, in a folder of their own that goes when the
    result stands: steps are written inside ``with``, and so is the result,
    which stays."""

    def __init__(self, spark: SparkSession, what: str):
        self.spark, self.name = spark, f"{what}-{uuid.uuid4().hex}"
        self.folder = f"{ensure_checkpoint_dir(spark)}/starloom-llm/{self.name}"
        self.steps = 0

    def written(self, df: DataFrame, what: str = "step") -> DataFrame:
        """Like the function ``written``, in this folder."""
        self.steps += 1
        path = f"{self.folder}/{self.steps:02d}-{what}"
        df.write.mode("errorifexists").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def result(self, df: DataFrame) -> DataFrame:
        return written(df, f"{self.name}-result")

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of finished phases: it does
    so once the driver's JVM has collected the plans that made them."""
    import gc
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def word_count(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unused(df_columns: list[str], *names: str) -> list[str]:
    """The columns of a frame without those an operator is about to add."""
    low = {n.lower() for n in names}
    return [c for c in df_columns if c.lower() not in low]


def q(name: str) -> Column:
    """A column by its literal name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")
