"""File-arrival streams: source profile and star refresh."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.sources.readers import FREE_TEXT_SOURCES, extract_glob
from starloom.sources.schemas import FILE_NAMES, SCHEMAS


def _csv_stream(spark: SparkSession, folder: str, schema: T.StructType, pattern: str | None,
                max_files: int | None, multi_line: bool = True) -> DataFrame:
    reader = (spark.readStream.schema(schema).option("header", True).option("multiLine", multi_line)
              .option("escape", '"').option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss"))
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(folder)


def profile_arrivals(spark: SparkSession, folder: str, source: str, profile_path: str,
                     checkpoint: str, pattern: str | None = None, max_files: int | None = None,
                     available_now: bool = True):
    """Append (source, file_path, row_count, column_count, batch_id) for each
    extract file of ``source`` that lands in ``folder``.

    A file is read whole in one micro-batch, so a per-batch group-by on the
    file path gives its final row count without streaming state.
    Returns the started query (call ``awaitTermination`` on it).
    """
    schema = SCHEMAS[source]
    stream = _csv_stream(spark, folder, schema, pattern, max_files,
                         multi_line=source in FREE_TEXT_SOURCES)
    stream = stream.select(F.col("_metadata.file_path").alias("file_path"))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        out = (batch.groupBy("file_path").agg(F.count(F.lit(1)).cast("long").alias("row_count"))
               .select(F.lit(source).alias("source"), "file_path", "row_count",
                       F.lit(len(schema.fields)).alias("column_count"),
                       F.lit(batch_id).cast("long").alias("batch_id")))
        out.write.mode("overwrite").parquet(f"{profile_path.rstrip('/')}/batch_id={batch_id}")

    w = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="2 minutes")
    return w.start()


def refresh_on_arrival(spark: SparkSession, extracts: str, target: str, checkpoint: str,
                       load: Callable[[SparkSession, str], dict] | None = None,
                       available_now: bool = True, stable_keys: bool = True,
                       file_names: dict[str, str] | None = None, **build_opts):
    """Rebuild and rewrite the whole star when new order extracts arrive.

    The stream only watches the orders extract files; the rebuild itself
    reads every source from ``extracts`` (``load`` defaults to
    ``load_sources(spark, extracts, file_names=...)``) and publishes through
    ``write_star_tables``, so readers never see a half-written star.
    With ``stable_keys`` members keep their surrogate keys across refreshes,
    and keys of retired members are not given to others.
    """
    from starloom.sinks import write_star_tables
    from starloom.sources.readers import load_sources

    names = {**FILE_NAMES, **(file_names or {})}
    load = load or (lambda s, path: load_sources(s, path, file_names=names))
    stream = _csv_stream(spark, extracts, SCHEMAS["orders"], extract_glob(names["orders"]), None,
                         multi_line=False)
    stream = stream.select(F.lit(1).alias("one"))

    def rebuild(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        keep_keys = stable_keys and "previous" not in build_opts and build_opts.get("fmt") != "csv"
        write_star_tables(spark, load(spark, extracts), target, stable_keys=keep_keys, **build_opts)

    w = stream.writeStream.foreachBatch(rebuild).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 hour")
    return w.start()
