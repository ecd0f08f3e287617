"""Not-modified revisit resolution for web archives.

Each revisit record (status 304) is joined to the latest earlier full response
of the same canonical URL, its validators are compared, and the headers a 304
may update are merged into the stored ones.  The as-of join is native: the
latest response of each (URL, time block) is an aggregate combined map-side,
carried over blocks, and only records of one block share a window, so a URL
holding a third of all records is spread over its blocks.

Header names are compared in lower case (of names that then agree the last in
order counts), ETags weakly: ``W/"x"`` matches ``"x"``.

Defined results: a revisit without an earlier response is ``orphan``; with an
ETag or Last-Modified that differs ``mismatch``; without validators
``unvalidated``; else ``resolved``.  A null URL is a URL of its own; of
responses at one time the greatest record_id counts; equal rows are reported
each; an empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

#: Headers that describe the stored body and that a 304 does not replace.
FIXED = ("content-length", "content-encoding", "content-type", "content-range", "transfer-encoding")


def canonical(url: Column) -> Column:
    """Lower-case host without www, no scheme, default port, fragment, tracking parameter or last slash."""
    u = F.regexp_replace(F.trim(url), "#.*$", "")
    host = F.lower(F.regexp_replace(F.regexp_extract(u, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^/?]*)", 1), r"^(?i:www\.)|:(80|443)$", ""))
    rest = F.regexp_replace(u, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?[^/?]*", "")
    rest = F.regexp_replace(rest, r"(?<=[?&])(utm_[a-z]+|gclid|fbclid)=[^&]*&?", "")
    return F.concat(host, F.regexp_replace(F.regexp_replace(rest, r"[?&]+$", ""), r"/+$", ""))


def _named(headers: Column) -> Column:
    """Headers under lower-case names; of equal ones the last in order of name."""
    e = F.array_sort(F.map_entries(headers))
    last = F.filter(e, lambda x, i: ~F.exists(F.slice(e, i + 2, F.greatest(F.size(e) - i - 1, F.lit(0))), lambda y: F.lower(y["key"]) == F.lower(x["key"])))
    return F.map_from_entries(F.transform(last, lambda x: F.struct(F.lower(x["key"]).alias("key"), x["value"].alias("value"))))


def _validator(name: str, value: Column) -> Column:
    value = F.trim(value)
    return F.regexp_replace(value, "^W/", "") if name == "etag" else value


def resolve(records: DataFrame, block: int = 1 << 16) -> DataFrame:
    """``records``: record_id, url, ts (long), status, headers (map).  One row per revisit."""
    r = records.select("record_id", canonical(F.col("url")).alias("canon"), "ts", "status", _named(F.col("headers")).alias("headers"))
    r = r.withColumns({"blk": F.floor(F.col("ts") / block), "full": F.when(F.col("status") == 200, F.struct("ts", "record_id", "headers"))})
    slim = F.when(F.col("status") == 200, F.struct("ts", "record_id"))
    last = r.where("status = 200").groupBy("canon", "blk").agg(F.max_by("full", slim).alias("last"))
    blocks = r.groupBy("canon", "blk").agg(F.count(F.lit(1)).alias("n"))
    both = (F.col("b.canon").eqNullSafe(F.col("l.canon"))) & (F.col("b.blk") == F.col("l.blk"))
    carry = (blocks.alias("b").join(last.alias("l"), both, "left").select("b.canon", "b.blk", "l.last")
             .withColumn("before", F.last("last", ignorenulls=True).over(
                 W.partitionBy("canon").orderBy("blk").rowsBetween(W.unboundedPreceding, -1))).drop("last"))
    inside = W.partitionBy("canon", "blk").orderBy("ts").rangeBetween(W.unboundedPreceding, -1)
    here = F.max_by("full", F.when(F.col("full").isNotNull(), F.struct("ts", "record_id"))).over(inside)
    r = r.withColumn("here", here).where("status = 304")
    same = (F.col("r.canon").eqNullSafe(F.col("c.canon"))) & (F.col("r.blk") == F.col("c.blk"))
    r = r.alias("r").join(carry.alias("c"), same, "left").withColumn("src", F.coalesce("here", "before"))
    mine, old = F.col("r.headers"), F.col("src.headers")
    given = F.lit(False)
    differs = F.lit(False)
    for name in ("etag", "last-modified"):
        a, b = _validator(name, mine[name]), _validator(name, old[name])
        given = given | (a.isNotNull() & b.isNotNull())
        differs = differs | F.coalesce(a != b, F.lit(False))
    verdict = (F.when(F.col("src").isNull(), "orphan").when(differs, "mismatch").when(given, "resolved").otherwise("unvalidated"))
    permitted = F.map_filter(mine, lambda k, v: ~k.isin(*FIXED))
    merged = F.map_concat(F.map_filter(old, lambda k, v: ~F.map_contains_key(permitted, k)), permitted)
    return r.select(F.col("r.record_id").alias("record_id"), F.col("r.canon").alias("url"), F.col("r.ts").alias("ts"), verdict.alias("verdict"),
                    F.col("src.record_id").alias("response_id"),
                    F.when(verdict == "resolved", F.to_json(F.map_from_entries(F.array_sort(F.map_entries(merged))))).alias("headers"))


#: Ticks between two fetches of a crawl, and how late a page is asked for again at most.
STEP, LATE = 40_000, 1 << 21


def captures(pages: DataFrame) -> DataFrame:
    """Records of a crawl of section fronts, the host and first path part of
    every page: each page is one capture of its section, in the order of its
    id, with the body's ETag.  A client that holds a page asks again some time
    later, as its body's checksum says: if the section has not changed since,
    the server's 304 belongs to that capture, else to another one.  Every tenth
    body's first fetch is lost."""
    digest = F.md5(F.coalesce("html", F.lit("")).cast("binary"))
    late = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    p = pages.select("page_id", F.concat(F.regexp_extract("url", r"^([^/]*//[^/]*/[^/?#]*)", 1), F.lit("/")).alias("url"),
                     F.concat(F.lit('"'), digest, F.lit('"')).alias("tag"),
                     F.length("html").cast("string").alias("size"), (F.col("page_id") * STEP).alias("ts"), late.alias("late"))
    made = lambda rows, n, ts, status, **headers: rows.select(
        (F.col("page_id") * 2 + n).alias("record_id"), "url", ts.alias("ts"), F.lit(status).alias("status"),
        F.create_map(*[x for k, v in {**headers, "Date": ts.cast("string")}.items() for x in (F.lit(k.replace("_", "-")), v)]).alias("headers"))
    full = made(p.where(F.col("late") % 10 != 7), 0, F.col("ts"), 200, ETag=F.col("tag"), Content_Type=F.lit("text/html"),
                Content_Length=F.coalesce("size", F.lit("0")))
    again = made(p, 1, F.col("ts") + 1 + F.col("late") % LATE, 304, etag=F.concat(F.lit("W/"), "tag"), Content_Length=F.lit("0"))
    return full.unionByName(again)
