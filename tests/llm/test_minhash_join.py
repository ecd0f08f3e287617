"""The MinHash join against brute force, and its parts."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from starloom.llm import blocks
from starloom.llm import minhash_join as MJ
from starloom.llm.common import Scratch, table

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, node long, n long, th long, kept string"


def brute(rows, k=3, num=85, den=100):
    """(doc_id, n_shingles, component_id, kept) by holding all sets against each other."""
    sets = []
    for _, t in rows:
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets.append(frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)]) if w else frozenset())
    kinds = sorted({s for s in sets if s}, key=len)
    at = {s: i for i, s in enumerate(kinds)}
    root = list(range(len(kinds)))

    def find(i):
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i
    for i, a in enumerate(kinds):
        for j in range(i + 1, len(kinds)):
            b = kinds[j]
            if len(a) * den < len(b) * num:
                break
            if den * len(a & b) >= num * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for (d, _), s in zip(rows, sets):
        if s and d is not None:
            c = find(at[s])
            least[c] = min(d, least.get(c, d))
    out = []
    for (d, _), s in zip(rows, sets):
        label = least.get(find(at[s])) if s else d
        out.append((d, len(s), label, d == label))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, 3, "x") for i, t in rows], SCHEMA)


def got(df):
    return sorted((tuple(r)[:4] for r in df.collect()), key=repr)


def made(seed=2):
    rng = np.random.default_rng(seed)
    words = [f"W{i}" for i in range(400)]
    text = lambda n: " ".join(rng.choice(words, n))
    base = text(120).split()
    rows = [(None, None), (1, ""), (2, " \n\t"), (3, "One"), (4, "one"), (5, "one two"), (None, "three words here"), (6, "THREE words\nhere"),
            (None, "only null ids"), (None, "only null ids"), (7, text(20_000))]
    rows += [(7, rows[-1][1])] * 2
    for i in range(60):  # near copies, some below the limit
        t = list(base)
        for at in rng.integers(0, len(t), rng.integers(0, 5)):
            t[at] = f"new{i}"
        rows.append((100 + i, " ".join(t)))
    passage = text(90)
    rows += [(200 + i, passage + " " + text(30)) for i in range(40)]  # a passage most of each text
    rows += [(300 + i, text(int(rng.integers(1, 60)))) for i in range(60)]
    chain = list(rng.choice(words, 100))
    for i in range(12):  # each links with the next only
        rows.append((400 + i, " ".join(chain[i * 5:] + [f"end{j}" for j in range(i * 5)])))
    return rows


@pytest.mark.parametrize("block", [512, 4])
def test_against_brute_force(spark, block):
    rows = made()
    assert got(MJ.near_duplicates(frame(spark, rows).repartition(4), block=block)) == brute(rows)


def test_documents_against_brute_force(spark):
    docs = table(spark, SF_SMALL, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert got(MJ.near_duplicates(docs)) == brute(rows)


def test_empty_table_and_names(spark):
    assert MJ.near_duplicates(frame(spark, [])).count() == 0
    named = spark.createDataFrame([("b", "x y z"), ("a", "X y z"), (None, None)], "key string, body string")
    assert got(MJ.near_duplicates(named, "key", "body")) == [("a", 1, "a", True), ("b", 1, "a", False), (None, 0, None, True)]


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(5)
    for share in (0.5, 0.85, 0.95):
        hits = []
        for _ in range(60):
            both = rng.integers(1, 2 ** 63, 1000, dtype=np.uint64)
            n = int(1000 * share)
            rest = (1000 - n) // 2
            a, b = np.sort(both[:n + rest]), np.sort(np.concatenate([both[:n], both[n + rest:n + 2 * rest]]))
            sig = MJ.signatures(np.array([len(a), len(b)]), np.concatenate([a, b]))
            hits.append(int((sig[0] == sig[1]).sum()))
        assert abs(np.mean(hits) / MJ.M - share) < 0.03
        if share >= 0.85:
            assert min(hits) >= MJ.MATCH


def test_prefix_keeps_every_pair_above_the_threshold(spark):
    """Random signatures of few values: each pair that agrees often enough shares a posting."""
    rng = np.random.default_rng(6)
    m, match = 12, 7
    sig = [[c * 100 + int(rng.integers(0, 3)) for c in range(m)] for _ in range(60)]
    sets = spark.createDataFrame([(i + 1, s) for i, s in enumerate(sig)], "node long, postings array<long>")
    prefix = {}
    for t, node in MJ.prefixes(sets, m, match).collect():
        prefix.setdefault(node, set()).add(t)
    for i in range(60):
        assert len(prefix.get(i + 1, ())) <= m - match + 1
        for j in range(i):
            if sum(a == b for a, b in zip(sig[i], sig[j])) >= match:
                assert prefix[i + 1] & prefix[j + 1]


def test_parts_of_a_list():
    rng = np.random.default_rng(7)
    n = 300
    short = rng.integers(0, 2, (n, MJ.M)).astype(np.uint16)
    short[:, :40] = 7
    node, comp, size = np.arange(n) + 10, rng.integers(0, 20, n), rng.integers(80, 120, n)
    base = rng.integers(1, 2 ** 63, 400, dtype=np.uint64)
    sets = [np.sort(base[i % 8:i % 8 + s]) for i, s in enumerate(size)]
    sketch = [MJ.sketches(np.array([len(s)]), s)[0] for s in sets]
    differ = lambda i, j: len(np.setxor1d(sets[i], sets[j]))
    pairs = [(i, j) for i in range(n) for j in range(i) if comp[i] != comp[j]
             and min(size[i], size[j]) * 100 >= max(size[i], size[j]) * 85 and (short[i] == short[j]).sum() >= 55]
    may = {(int(node[j]), int(node[i])) for i, j in pairs if blocks.apart(sketch[i], sketch[j]) <= blocks.may_differ(size[i], size[j], 85, 100)}
    link = {(int(node[j]), int(node[i])) for i, j in pairs if differ(i, j) <= blocks.may_differ(size[i], size[j], 85, 100)}
    assert link <= may and len(may) < len(pairs)

    def args(rows, block):
        at = np.flatnonzero(rows)
        agree = lambda order, j, i: MJ.collisions(short[at[order[j]]], short[at[order[i]]]) >= 55
        return (block[rows], *(c[rows] for c in (node, comp, size)), [sketch[i] for i in at], 85, 100), {"agree": agree}
    one, every = np.zeros(n, int), np.ones(n, bool)
    (x, more) = args(every, one)
    u, v = blocks.across(*x, **more)
    assert set(zip(u.tolist(), v.tolist())) == may and len(u) == len(may)
    block, got_ = rng.integers(0, 3, n), []
    for a in range(3):
        for z in range(a, 3):
            x, more = args((block == a) | (block == z), block)
            x = blocks.across(*x, **more)
            got_ += list(zip(x[0].tolist(), x[1].tolist()))
    assert set(got_) == may and len(got_) == len(may)
    # a forest: pairs of the same set that join as much, one less than what they join
    x, more = args(every, one)
    fu, fv = blocks.across(*x, **more, forest=True)
    assert set(zip(fu.tolist(), fv.tolist())) <= may
    of = dict(zip(node.tolist(), comp.tolist()))

    def joined(pairs):
        root = {c: c for c in of.values()}

        def find(c):
            while root[c] != c:
                c = root[c]
            return c
        for x, y in pairs:
            root[find(of[x])] = find(of[y])
        return {frozenset(c for c in root if find(c) == r) for r in map(find, root)}
    assert joined(zip(fu.tolist(), fv.tolist())) == joined(may)
    assert len(fu) == len(set(of.values())) - len(joined(may))


def test_sketches_differ_no_more_than_sets():
    rng = np.random.default_rng(8)
    for _ in range(200):
        pool = rng.integers(1, 2 ** 63, 600, dtype=np.uint64)
        a, b = (np.unique(rng.choice(pool, int(rng.integers(1, 500)))) for _ in range(2))
        x, y = MJ.sketches(np.array([len(a), len(b)]), np.concatenate([a, b]))
        assert blocks.apart(x, y) <= len(np.setxor1d(a, b))
        m, n = len(a), len(b)
        both = next(c for c in range(m + n + 1) if 100 * c >= 85 * (m + n - c))  # the least overlap that links
        assert blocks.may_differ(m, n, 85, 100) == m + n - 2 * both


def test_null_ids_fetch_one_text_a_node(spark):
    """Rows of null ids with different texts are not crossed with each other."""
    rng = np.random.default_rng(9)
    base = [f"w{i}" for i in rng.integers(0, 500, 100)]
    rows = [(None, " ".join([*base[:i], "x", *base[i + 1:]])) for i in range(50)]
    docs = frame(spark, rows)
    with Scratch(spark, "test") as s:
        MJ.links(docs, s)
        assert spark.read.parquet(next(p for p in (f"{s.folder}/{i:02d}-items" for i in range(9)) if _there(s, p))).count() == 50
    assert got(MJ.near_duplicates(docs)) == brute(rows)


def _there(s, path):
    p = s.spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(s.spark._jsc.hadoopConfiguration()).exists(p)


def test_steps_are_deleted_and_results_stay(spark):
    with Scratch(spark, "test") as s:
        s.written(spark.range(3))
        kept = s.result(spark.range(4).withColumn("x", F.lit(1)))
        folder = s.folder
    assert kept.count() == 4 and not _there(s, folder)
