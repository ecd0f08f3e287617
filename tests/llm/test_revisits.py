"""Not-modified revisits against a plain loop, and the query's own statement."""

import json

import numpy as np
import pytest
from oracle_compare import compare, duck
from pyspark.sql import functions as F

from conftest import SF_ORACLE
from starloom.llm import oracle
from starloom.llm import warc_revisit as WR
from starloom.llm.common import table
from starloom.llm.queries import QUERIES

SCHEMA = "record_id long, url string, ts long, status int, headers map<string,string>, verdict string, src int, n int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "old", 1, 2) for r in rows], SCHEMA)


def plain(rows):
    """Each revisit against all earlier responses of its URL (already canonical)."""
    out = []
    for i, url, ts, status, h in rows:
        if status != 304:
            continue
        before = [r for r in rows if r[3] == 200 and r[1] == url and r[2] < ts]
        src = max(before, key=lambda r: (r[2], r[0]), default=None)
        mine = {k.lower(): v for k, v in sorted((h or {}).items())}
        old = {k.lower(): v for k, v in sorted((src[4] or {}).items())} if src else {}
        strip = lambda n, v: v.strip().removeprefix("W/") if n == "etag" else v.strip()
        both = [n for n in ("etag", "last-modified") if n in mine and n in old]
        if src is None:
            verdict = "orphan"
        elif any(strip(n, mine[n]) != strip(n, old[n]) for n in both):
            verdict = "mismatch"
        else:
            verdict = "resolved" if both else "unvalidated"
        merged = {**old, **{k: v for k, v in mine.items() if k not in WR.FIXED}}
        out.append((i, ts, verdict, src and src[0], json.dumps(dict(sorted(merged.items())), separators=(",", ":")) if verdict == "resolved" else None))
    return sorted(out)


def got(df):
    return sorted((r.record_id, r.ts, r.verdict, r.response_id, r.headers) for r in df.collect())


@pytest.mark.parametrize("block", [10, 1 << 16])
def test_against_a_plain_loop(spark, block):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(400):
        url = [None, "a.org/x", "a.org/y", "hot.org"][rng.choice(4, p=[.1, .2, .2, .5])]
        h = {}
        if rng.random() < .8:
            h[str(rng.choice(["ETag", "etag", "ETAG"]))] = str(rng.choice(['"p"', 'W/"p"', '"q"', ' "p" ']))
        if rng.random() < .3:
            h["Last-Modified"] = str(rng.choice(["Mon", "Tue"]))
        if rng.random() < .5:
            h["X-Cache"], h["Content-Length"] = str(i), "5"
        rows.append((i, url, int(rng.integers(0, 300)), int(rng.choice([200, 304, 404])), h))
    assert got(WR.resolve(frame(spark, rows), block=block)) == plain(rows)


def test_case_of_names_and_weak_tags(spark):
    old = (1, "u.org", 5, 200, {"ETag": '"p"', "Server": "a"})
    for mine, verdict in (({"etag": 'W/"p"'}, "resolved"), ({"ETAG": '"q"'}, "mismatch"), ({"X": "1"}, "unvalidated"), ({}, "unvalidated")):
        assert WR.resolve(frame(spark, [old, (2, "u.org", 6, 304, mine)])).first().verdict == verdict
    both = WR.resolve(frame(spark, [old, (2, "u.org", 6, 304, {"ETag": '"p"', "etag": '"p"', "SERVER": "b"})])).first()
    assert json.loads(both.headers) == {"etag": '"p"', "server": "b"}


def test_null_headers_empty_table_and_repeats(spark):
    rows = [(1, "u.org", 5, 200, None), (2, "u.org", 6, 304, None), (2, "u.org", 6, 304, None), (3, "u.org", 5, 304, {})]
    assert [r[2] for r in got(WR.resolve(frame(spark, rows)))] == ["unvalidated", "unvalidated", "orphan"]
    assert WR.resolve(frame(spark, [])).count() == 0


def test_the_join_decides_the_query(spark):
    """Verdicts change if the first earlier response were taken for the latest."""
    records = WR.captures(table(spark, SF_ORACLE, "pages"))
    rows = [(r.record_id, r.url, r.ts, r.status, r.headers) for r in records.withColumn("url", WR.canonical(F.col("url"))).collect()]
    latest = {r[0]: r[2] for r in plain(rows)}
    assert latest == {r[0]: r[2] for r in got(WR.resolve(records))}
    kinds = set(latest.values())
    assert kinds == {"orphan", "mismatch", "resolved"}
    turned = plain([(i if s == 304 else -i, u, t if s == 304 else -t - 10 ** 12, s, h) for i, u, t, s, h in rows])  # order of responses reversed
    assert sum(latest[r[0]] != r[2] for r in turned) > 50


def test_query_matches_its_statement(spark):
    problems, n = compare(QUERIES["op9_warc_revisit"](spark, SF_ORACLE), duck(SF_ORACLE), oracle.oracle_sql()["op9_warc_revisit"])
    assert not problems and n > 0, problems
