"""Fill-in-middle and lexical search: the given statements, a plain restatement
on small tables with nulls, empties, ties, repeats and clashing columns."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from oracle_compare import compare, duck

from conftest import SF_ORACLE
from starloom.llm import fill_in_middle as FIM
from starloom.llm import lexical_search as LS
from starloom.llm import oracle
from starloom.llm.queries import QUERIES

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, n long, form string, rank long, score string, item_id long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 0, "x", 1, "y", 2) for i, t in rows], SCHEMA)


@pytest.mark.parametrize("name", ["op11_fill_in_middle", "op13_lexical_search"])
def test_query_matches_its_statement(spark, name):
    problems, _ = compare(QUERIES[name](spark, SF_ORACLE), duck(SF_ORACLE), oracle.oracle_sql()[name])
    assert not problems, problems


def fim_plain(doc_id, text, rate=100, spm=50):
    """The transformation as a few lines over the whole text."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    d = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(d[8 * i:8 * i + 8], 16) for i in range(4)]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return doc_id, n, "plain", None, None, sha(text), sha(text), text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    form = "spm" if h[3] % 100 < spm else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return doc_id, n, form, len(p), len(m), sha(out), sha(text), out


def texts():
    rng = random.Random(4)
    line = lambda n: "".join(rng.choice("abé <M\U0001F600\r\t") for _ in range(n))
    rows = [(None, None), (None, "a\nb"), (None, "a\nb"), (1, ""), (2, "\n"), (3, "no newline"), (4, "<P> inside\nx"), (5, "<\n<S\n>\n<M")]
    rows += [(6, "one\ntwo\nthree\n")] * 3 + [(6, "other\n")] + [(7, "x" * 200_000 + "\n" + "yé" * 90_000)]
    rows += [(100 + i, "\n".join(line(rng.randrange(30)) for _ in range(rng.randrange(1, 40)))) for i in range(200)]
    return rows


@pytest.mark.parametrize("rate,spm", [(100, 50), (60, 0)])
def test_fill_in_middle(spark, rate, spm):
    rows = texts()
    got = FIM.transform(frame(spark, rows).repartition(3), rate=rate, spm=spm).collect()
    assert sorted(map(tuple, got), key=repr) == sorted((fim_plain(i, t, rate, spm) for i, t in rows), key=repr)


def test_fill_in_middle_without_texts_and_rows(spark):
    out = FIM.transform(frame(spark, []), texts=False)
    assert out.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    assert out.count() == 0
    named = spark.createDataFrame([("k1", "a\nb\nc")], "id string, body string")
    assert FIM.transform(named, "id", "body").first()["doc_id"] == "k1"


def test_marks_over_piece_borders():
    out = b"<P>ab<<S>c<M><M>dd"  # a suffix that ends before its mark, a middle that begins like one
    for size in (1, 2, 3, 5, 50):
        got = {}
        for place, b in FIM.restored("psm", iter(out[i:i + size] for i in range(0, len(out), size))):
            got[place] = got.get(place, b"") + b
        assert got == {0: b"ab<", 2: b"c", 1: b"<M>dd"}


def test_the_second_sort_needs_no_shuffle(spark):
    from pyspark.rdd import portable_hash
    rdd = spark.sparkContext.parallelize([((i, 0), b"") for i in range(9)])
    one = rdd.repartitionAndSortWithinPartitions(3, portable_hash)
    two = one.mapPartitions(lambda x: x, preservesPartitioning=True).repartitionAndSortWithinPartitions(3, portable_hash)
    shuffles = lambda r: r._jrdd.rdd().toDebugString().count("ShuffledRDD")
    assert shuffles(one) == shuffles(two) == 1


def ranked(docs, items, k):
    """Ranking by its definition, a document and a term at a time."""
    lower = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    held = [(i, Counter(TERM.findall(lower(t)))) for i, t in docs]
    count = sum(1 for _, c in held if c)
    length = sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(TERM.findall(lower(t)))
    out = []
    for i, ts in asked.items():
        found = []
        for d, c in held:
            m = 50 + 50 * sum(c.values()) * count // length if length else 0
            s = sum(math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 20 * m))
                    for t in ts if t in c)
            if s > 0:
                found.append((-s, d is None, d))
        found.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(i, r + 1, d, -s) for r, (s, _, d) in enumerate(found[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("pairs,k", [(1_000_000, 50), (40, 5)])
def test_search(spark, pairs, k):
    rng = np.random.default_rng(8)
    word = lambda: rng.choice(["Straße", "ÉTÉ", "été", "a1", "it's", "x_y", "日本", "K"] + [f"w{i}" for i in range(60)])
    body = lambda n: rng.choice([" ", ", ", "--"]).join(word() for _ in range(n))
    docs = [(int(i), body(rng.integers(0, 60))) for i in range(150)] + [(None, body(20)), (None, body(9)), (3, "W1 w2"), (4, None), (5, ".,")]
    docs += [(900 + i, "same tie w5") for i in range(12)] + [(77, "w5 same tie")] * 3 + [(800, body(4000))]
    items = [(i, body(12)) for i in range(40)] + [(40, "tie w5"), (41, None), (42, "..."), (None, "w1 w2"), (None, "w3"), (0, body(5)), (43, "nowhere")]
    got = LS.search(frame(spark, docs).repartition(5), frame(spark, [(i, t) for i, t in items]).select("item_id", "doc_id", "text")
                    .drop("item_id").withColumnRenamed("doc_id", "item_id"), k=k, pairs=pairs)
    assert sorted(map(tuple, got.collect()), key=repr) == ranked(docs, items, k)


def test_search_without_documents_or_items(spark):
    some, none = frame(spark, [(1, "a b")]), frame(spark, [])
    for docs, items in ((some, none), (none, some), (none, none), (frame(spark, [(1, None)]), some)):
        assert LS.search(docs, items.select("doc_id", "text"), item_col="doc_id").count() == 0


def test_search_over_parts_of_long_texts(monkeypatch, spark):
    monkeypatch.setattr(LS.TS, "CHUNK", 64)
    import pyarrow as pa
    text = [" ".join(f"t{i % 7}" for i in range(300)), "z" * 500 + " t1", ""]
    got = {}
    for lo, hi, counts, h in LS.terms(pa.array(text)):
        for i, c in zip(range(lo, hi), counts):
            got[i] = int(c)
    assert got == {0: 300, 1: 2, 2: 0}


def test_runs_of_a_vocabulary_stay_exact():
    weights = np.full(5000, 10 ** 7, np.int64)  # 901 of them times the largest impact pass 2^53
    out = LS.tiles(np.zeros(5000, np.int64), np.arange(5000), weights, 1)
    assert sum(len(run) for run, _ in out[0][1]) == 5000
    assert all(int(w.sum()) * LS.MOST_IMPACT < LS.EXACT for _, w in out[0][1])
    n = np.array([10 ** 9, 7], np.int64)
    assert LS.norms(n, 10 ** 12, 10 ** 15).tolist() == [50 + 50 * int(x) * 10 ** 12 // 10 ** 15 for x in n]
