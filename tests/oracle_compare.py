"""Compare a Spark query with its DuckDB oracle the way the driver does:
same row count, same column names (sorted), same multiset of rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr), [names[i] for i in order]


def compare(spark_df, con, sql: str):
    s_rows = spark_df.collect()
    s_names = spark_df.columns
    cur = con.execute(sql)
    d_names = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    s_sorted, s_cols = rows_of(s_names, s_rows)
    d_sorted, d_cols = rows_of(d_names, d_rows)
    problems = []
    if s_cols != d_cols:
        problems.append(f"columns differ: spark={s_cols} duckdb={d_cols}")
    if len(s_rows) != len(d_rows):
        problems.append(f"row count: spark={len(s_rows)} duckdb={len(d_rows)}")
    elif s_sorted != d_sorted:
        diff = [(a, b) for a, b in zip(s_sorted, d_sorted) if a != b][:3]
        problems.append(f"values differ, e.g. {diff}")
    return problems, len(s_rows)
