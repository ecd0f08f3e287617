"""Bad records kept, counted and told apart instead of read as nulls.

An extract is read as text and every field is converted by a cast that cannot
fail.  A record is rejected when a field that holds text does not convert, or
when it has more or fewer fields than the header: such records go to a
quarantine frame with their source, file, reason and raw text, and the accepted
rest is typed as the schema says.  Null tokens are nulls, in any column, and
never a reason.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
#: The default format, as a pattern: a cast alone would also take other forms.
_DEFAULT_SHAPE = r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d$"
_RECORD = "__sl_record"

QUARANTINE = T.StructType([T.StructField("source", T.StringType()), T.StructField("file", T.StringType()),
                           T.StructField("reason", T.StringType()), T.StructField("record", T.StringType())])


@dataclass
class Parsed:
    """``rows``: accepted, typed; ``rejected``: source, file, reason, record."""

    rows: DataFrame
    rejected: DataFrame


def converted(text: Column, kind: T.DataType, timestamp_format: str = DEFAULT_TIMESTAMP_FORMAT) -> Column:
    """``text`` as ``kind``, null where it does not convert."""
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        if timestamp_format == DEFAULT_TIMESTAMP_FORMAT:
            return F.when(F.trim(text).rlike(_DEFAULT_SHAPE), F.trim(text).try_cast(kind))
        return F.try_to_timestamp(text, F.lit(timestamp_format)).cast(kind)
    if isinstance(kind, T.DecimalType):  # more decimals than the type holds would be rounded away
        return F.when(F.trim(text).rlike(rf"^[+-]?\d*(\.\d{{0,{kind.scale}}}0*)?$"), text.try_cast(kind))
    return text.try_cast(kind)


def parse_csv(spark: SparkSession, path, schema: T.StructType, source: str, null_tokens=None,
              timestamp_format: str = DEFAULT_TIMESTAMP_FORMAT, multi_line: bool = True) -> Parsed:
    """Read an extract; both frames are lazy scans of the same files."""
    names = [f.name for f in schema.fields]
    text = T.StructType([*[T.StructField(n, T.StringType()) for n in names], T.StructField(_RECORD, T.StringType())])
    # all columns are parsed whatever is selected: else short and long records would pass unseen
    raw = (spark.read.schema(text).option("header", True).option("multiLine", multi_line).option("escape", '"')
           .option("quote", '"').option("enforceSchema", False).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", _RECORD).option("columnPruning", False).csv(path))
    raw = raw.withColumn("__sl_file", F.col("_metadata.file_path"))
    tokens = [t for t in (null_tokens or []) if t != ""]
    if tokens:
        raw = raw.withColumns({n: F.when(F.col(n).isin(tokens), F.lit(None).cast("string")).otherwise(F.col(n)) for n in names})
    typed = {f.name: converted(F.col(f.name), f.dataType, timestamp_format) for f in schema.fields}
    shape = F.when(F.col(_RECORD).isNotNull(), F.lit("number of fields"))
    # the values of a record of the wrong length stand in the wrong columns: one reason is enough
    fields = [F.when(F.col(n).isNotNull() & typed[n].isNull(), F.lit(f"{n} is no {schema[n].dataType.simpleString()}"))
              for n in names if not isinstance(schema[n].dataType, T.StringType)]
    reason = F.coalesce(shape, F.nullif(F.concat_ws("; ", *fields), F.lit(""))) if fields else shape
    judged = raw.withColumn("__sl_reason", reason)
    rows = judged.where(F.col("__sl_reason").isNull()).select(*[typed[n].alias(n) for n in names])
    record = F.coalesce(F.col(_RECORD), F.to_csv(F.struct(*names)))
    rejected = judged.where(F.col("__sl_reason").isNotNull()).select(
        F.lit(source).alias("source"), F.col("__sl_file").alias("file"), F.col("__sl_reason").alias("reason"), record.alias("record"))
    return Parsed(rows, rejected)


class Sources(dict):
    """Source frames by name, with the frames of their rejected records."""

    def __init__(self, frames: dict[str, DataFrame], rejected: dict[str, DataFrame] | None = None):
        super().__init__(frames)
        self.rejected = dict(rejected or {})

    def quarantine(self) -> DataFrame | None:
        """All rejected records; None where nothing was read with a quarantine."""
        return reduce(DataFrame.unionByName, self.rejected.values()) if self.rejected else None


def rejection_checks(quarantine: DataFrame, names) -> list[tuple]:
    """A check row per source: rejected records, expected none.  Reads one
    column of the written quarantine."""
    found = dict(quarantine.groupBy("source").count().collect())
    return [("rejected_records", n, int(found.get(n, 0)), 0, not found.get(n, 0)) for n in names]
