"""Source scans.

CSV is read with a fixed schema (no inference pass), ``multiLine`` so quoted
newlines in free text survive, and ``""`` as the quote escape.  Only the empty
string is null unless a null-token list is given.  Nothing is lost in silence:
a record that does not fit its schema fails the job (``FAILFAST``) or is kept in
a quarantine, an extract is found by its exact name, and an absent one is an
error.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.folders import Folders
from starloom.operators.lookups import remember_bytes, remember_rows
from starloom.sources.quarantine import DEFAULT_TIMESTAMP_FORMAT, Sources, parse_csv
from starloom.sources.schemas import FILE_NAMES, OPTIONAL_SOURCES, SCHEMAS


class MissingExtract(FileNotFoundError):
    """No file of a required extract is in the folder."""


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None,
             null_tokens=None, timestamp_format: str = DEFAULT_TIMESTAMP_FORMAT,
             multi_line: bool = True, mode: str = "FAILFAST",
             check_header: bool = True) -> DataFrame:
    """Header CSV with a fixed schema and explicit null tokens.

    ``check_header`` makes Spark compare the header with the schema names
    instead of assigning columns by position, so a reordered extract fails
    rather than loading shifted.  ``mode="FAILFAST"`` fails on a record that
    does not fit the schema; ``"PERMISSIVE"`` reads what does not convert as
    null; ``quarantine.parse_csv`` keeps such records apart.
    """
    reader = (spark.read.option("header", True).option("multiLine", multi_line)
              .option("escape", '"').option("quote", '"')
              .option("timestampNTZFormat", timestamp_format)
              .option("timestampFormat", timestamp_format)
              .option("enforceSchema", not check_header)
              .option("mode", mode))
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.csv(path)
    tokens = [t for t in (null_tokens or []) if t != ""]
    if tokens:
        strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
        df = df.withColumns({c: F.when(F.col(c).isin(tokens), F.lit(None).cast("string"))
                                 .otherwise(F.col(c)) for c in strings})
    return df


def _name_parts(file_name: str) -> tuple[str, str]:
    stem, dot, ext = file_name.rpartition(".")
    return (stem, dot + ext) if dot else (file_name, "")


def extract_files(names, file_name: str) -> list[str]:
    """Those of ``names`` that belong to an extract: ``x.csv`` itself and its
    numbered parts ``x_2.csv``; no other file whose name begins alike."""
    stem, ext = _name_parts(file_name)
    ours = re.compile(re.escape(stem) + r"(_\d+)?" + re.escape(ext))
    return sorted(n for n in names if ours.fullmatch(n))


def extract_glob(file_name: str) -> str:
    """The same as a glob, for streams (numbers of up to four digits)."""
    stem, ext = _name_parts(file_name)
    numbers = ["_" + "[0-9]" * n for n in range(1, 5)]
    return "{" + ",".join(stem + n + ext for n in ["", *numbers]) + "}"


def _join(base: str, name: str) -> str:
    return base.rstrip("/") + "/" + name if "://" in base else os.path.join(base, name)


# Extracts with free text (review titles and messages) that may
# hold quoted line breaks.  Only these are read with ``multiLine``: a
# multi-line CSV file cannot be split, so it is one task however large.
FREE_TEXT_SOURCES = ("order_reviews",)


def load_sources(spark: SparkSession, base_path: str, fmt: str = "csv",
                 names=None, null_tokens=None, file_names: dict | None = None,
                 multi_line_sources=FREE_TEXT_SOURCES, on_bad: str = "fail",
                 optional=OPTIONAL_SOURCES) -> Sources:
    """Every source under ``base_path`` as a DataFrame (lazy).

    ``fmt="csv"`` reads the extract files by name (``<name>.csv`` and numbered
    parts ``<name>_2.csv``) with fixed schemas; ``fmt="parquet"`` reads
    ``<base>/<source>`` parquet directories.  An absent source raises
    ``MissingExtract`` unless it is ``optional``.  CSV extracts outside
    ``multi_line_sources`` are read line by line, so a large file splits
    across tasks; name a source there if its text fields can hold line breaks.

    ``on_bad`` says what becomes of CSV records that do not fit the schema:
    ``"fail"`` the job, ``"quarantine"`` keeps them in the result's
    ``rejected`` frames (``write_star_tables`` publishes and counts them), and
    ``"null"`` reads what does not convert as null.
    """
    if on_bad not in ("fail", "quarantine", "null"):
        raise ValueError("on_bad is 'fail', 'quarantine' or 'null'")
    file_names = {**FILE_NAMES, **(file_names or {})}
    there = Folders(base_path, spark).names(base_path)
    out, rejected = {}, {}
    for name in names or SCHEMAS:
        wanted = file_names[name] if fmt == "csv" else name if fmt == "parquet" else name + ".parquet"
        found = extract_files(there, wanted) if fmt == "csv" else [wanted] if wanted in there else []
        if not found:
            if name in optional:
                continue
            raise MissingExtract(f"no {wanted} in {base_path}")
        paths = [_join(base_path, f) for f in found]
        multi_line = name in (multi_line_sources or ())
        if fmt != "csv":
            out[name] = spark.read.parquet(*paths)
        elif on_bad == "quarantine":
            parsed = parse_csv(spark, paths, SCHEMAS[name], name, null_tokens, multi_line=multi_line)
            out[name], rejected[name] = parsed.rows, parsed.rejected
        else:
            out[name] = read_csv(spark, paths, SCHEMAS[name], null_tokens=null_tokens, multi_line=multi_line,
                                 mode="FAILFAST" if on_bad == "fail" else "PERMISSIVE")
    return Sources(out, rejected)


def category_translation(spark: SparkSession, path: str | None = None,
                         rows: list[tuple[str, str]] | None = None) -> DataFrame:
    """The category translation reference table, from a CSV file or rows."""
    if path is not None:
        return read_csv(spark, path, SCHEMAS["category_translation"], multi_line=False)
    return rows_frame(spark, rows or [], SCHEMAS["category_translation"])


def rows_frame(spark: SparkSession, rows, schema: T.StructType) -> DataFrame:
    """A small fixed table as a JVM-side relation (``inline`` over one row):
    no Python worker starts to deserialize it, unlike ``createDataFrame`` on
    a list.  The row count is remembered, so a later broadcast check runs no
    job."""
    def lit_row(values):
        return F.struct(*[F.lit(v).cast(f.dataType).alias(f.name)
                          for v, f in zip(values, schema.fields)])
    if rows:
        df = spark.range(1).select(F.inline(F.array(*[lit_row(r) for r in rows])))
    else:
        df = spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name)
                                     for f in schema.fields])
    text = sum(len(str(v).encode()) for r in rows for v, f in zip(r, schema.fields)
               if v is not None and isinstance(f.dataType, T.StringType))
    return remember_bytes(remember_rows(df, len(rows)), text)
