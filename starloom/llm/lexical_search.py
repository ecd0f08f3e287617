"""Ranked lexical search by dense blocked multiplication.

Items are queries, documents are ranked by a sum over the terms they share:
an integer weight of the term times an integer impact of the term in the
document.  The sums come from matrix products:

1. the terms of all items, numbered, go to every task; a pass over the
   documents writes what each holds of them (term numbers and occurrences) and
   how many terms it has at all.  Document frequencies, the number of documents
   and their length are plain aggregates of that table;
2. items stand in tiles of ``ITEMS``.  A tile has a vocabulary of its own, cut
   into runs of ``TERMS``; per run there is a dense matrix of weights (items by
   terms).  Documents are taken ``DOCS`` at a time, and the impacts of the
   run's terms in them fill a dense matrix (terms by documents).  Their product
   is taken in float64.  All values are integers and a run's weights times the
   largest impact stay below 2^53, so the product is exact in any order of
   summation; runs are added in 64-bit integers;
3. a task keeps the ``k`` best documents of an item, ties by id, and the tasks'
   lists are merged in two steps, by (item, group of tasks) and by item.

Only the items are broadcast: at most ``PAIRS`` pairs of item and term (plus
the largest item) at once.  Larger sets of items are dealt into batches by a
hash, one pass over the documents each.

Terms are told apart by 64-bit hashes.  Defined results: null or termless texts
have no terms, and such items no rows; items of one id (null included) are one
item with the terms of all; repeated documents are ranked each, null ids after
others; very long texts are read whole; empty tables give an empty result;
other columns of the inputs play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from starloom.llm import textscan as TS
from starloom.llm.common import q, written

K = 50
ITEMS, TERMS, DOCS = 16, 1024, 2048
#: (item, term) pairs that one batch of items is dealt.
PAIRS = 1_000_000
#: An impact is below this: 10^9 * tf div (1000 * tf + 20 * m).
MOST_IMPACT = 1_000_000
EXACT = 1 << 53
_OUTSIDE = np.ones(256, bool)
_OUTSIDE[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def _bounds(seg: np.ndarray, rel: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the terms of ``seg``, texts beginning at ``rel``."""
    if not len(seg):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    out = _OUTSIDE[seg]
    cut = np.zeros(len(seg) + 1, bool)
    cut[rel] = True
    start, last = ~out, ~out
    start[1:] &= out[:-1] | cut[1:-1]
    last[:-1] &= out[1:] | cut[1:-1]
    return np.flatnonzero(start), np.flatnonzero(last) + 1


def _parts(data: np.ndarray, lo: int, hi: int) -> Iterator[tuple[int, int]]:
    """Parts of one long text, cut between terms."""
    while hi - lo > TS.CHUNK:
        at = lo + TS.CHUNK
        while at > lo and not _OUTSIDE[data[at - 1]]:
            at -= 1
        if at == lo:  # one term longer than a chunk
            at = lo + TS.CHUNK
            while at < hi and not _OUTSIDE[data[at]]:
                at += 1
        yield lo, at
        lo = at
    yield lo, hi


def terms(texts) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows ``lo:hi`` with the number of terms of each and the terms' hashes."""
    off, data = TS.column(texts)
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + TS.CHUNK, "right")) - 1)
        a, b = int(off[lo]), int(off[hi])
        if b - a <= TS.CHUNK:
            seg, rel = data[a:b], off[lo:hi + 1] - a
            start, end = _bounds(seg, rel)
            yield lo, hi, np.diff(np.searchsorted(start, rel)), TS.hashes(seg, start, end)
        else:
            got = [TS.hashes(data[x:y], *_bounds(data[x:y], np.array([0]))) for x, y in _parts(data, a, b)]
            h = np.concatenate(got)
            yield lo, hi, np.array([len(h)]), h
        lo = hi


def _item_terms(batches):
    for b in batches:
        for lo, hi, counts, h in terms(b.column(1)):
            who = np.repeat(np.arange(lo, hi), counts)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(who)), pa.array(h.view(np.int64))], ["item_id", "term"])


def _postings(vocabulary):
    """What documents hold of the vocabulary (sorted hashes)."""
    def run(batches):
        voc = vocabulary.value
        for b in batches:
            for lo, hi, counts, h in terms(b.column(1)):
                at = np.searchsorted(voc, h)
                at[at == len(voc)] = 0
                ok = voc[at] == h
                key = np.repeat(np.arange(hi - lo), counts)[ok] * len(voc) + at[ok]
                key, tf = np.unique(key, return_counts=True)
                ends = np.searchsorted(key, np.arange(hi - lo + 1) * len(voc)).astype(np.int32)
                lists = lambda v: pa.ListArray.from_arrays(pa.array(ends), pa.array(v))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array(counts.astype(np.int64)),
                     lists((key % len(voc)).astype(np.int32)), lists(tf.astype(np.int32))], ["doc_id", "n", "terms", "tfs"])
    return run


def weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


def norms(n: np.ndarray, docs: int, length: int) -> np.ndarray:
    """``m`` of documents with ``n`` terms each; exact where 64 bits would overflow."""
    if len(n) and 50 * int(n.max()) * docs >= 1 << 63:
        return np.array([50 + 50 * int(x) * docs // length for x in n], np.int64)
    return 50 + 50 * n * docs // length


def tiles(items: np.ndarray, terms_: np.ndarray, weights: np.ndarray, n_items: int) -> list[tuple]:
    """Pairs of item and term number as tiles: first item, and the runs
    (term numbers, weights as a dense matrix of items by terms) of each."""
    out = []
    for first in range(0, n_items, ITEMS):
        mine = (items >= first) & (items < first + ITEMS)
        voc = np.unique(terms_[mine])
        runs, lo = [], 0
        while lo < len(voc):
            upto = np.cumsum(weights[voc[lo:lo + TERMS]]) * MOST_IMPACT
            hi = lo + max(1, int(np.searchsorted(upto, EXACT)))  # partial sums stay below 2^53
            run = voc[lo:hi]
            here = mine & np.isin(terms_, run)
            w = np.zeros((min(ITEMS, n_items - first), len(run)))
            at = np.searchsorted(run, terms_[here])
            w[items[here] - first, at] = weights[terms_[here]]
            runs.append((run, w))
            lo = hi
        out.append((first, runs))
    return out


def best(k: int, item, score, none, doc) -> np.ndarray:
    """Places of the ``k`` best of each item: by score, then id, null last."""
    order = np.lexsort((doc, none, -score, item))
    i = item[order]
    first = np.searchsorted(i, i)
    return order[np.arange(len(i)) - first < k]


def _ranked(sent, k: int):
    """The ``k`` best documents of each item in a task."""
    def run(batches):
        m = sent.value
        n_items = len(m["ids"])
        top = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)]
        floor = np.ones(n_items, np.int64)  # scores below have no place
        for b in batches:
            for lo in range(0, b.num_rows, DOCS):
                part = b.slice(lo, DOCS)
                n = np.asarray(part.column(1))
                lists = part.column(2)
                ends = np.asarray(lists.offsets)
                term = np.asarray(lists.flatten())
                tf = np.asarray(part.column(3).flatten()).astype(np.int64)
                doc = np.repeat(np.arange(len(n)), np.diff(ends))
                impact = (1_000_000_000 * tf) // (1000 * tf + 20 * norms(n, m["docs"], m["length"])[doc])
                order = np.argsort(term, kind="stable")
                term, doc, impact = term[order], doc[order], impact[order].astype(np.float64)
                begin = np.searchsorted(term, np.arange(len(m["voc"]) + 1))
                ids = part.column(0)
                none = np.asarray(ids.is_null())
                ids = np.asarray(ids.fill_null(0))
                found = [top]
                for first, runs in m["tiles"]:
                    s = None
                    for voc, w in runs:
                        a, z = begin[voc], begin[voc + 1]
                        col = np.repeat(np.arange(len(voc)), z - a)
                        at = np.repeat(a - np.concatenate([[0], np.cumsum(z - a)[:-1]]), z - a) + np.arange(len(col))
                        d = np.zeros((len(voc), len(n)))
                        d[col, doc[at]] = impact[at]
                        got = (w @ d).astype(np.int64)
                        s = got if s is None else s + got
                    if s is not None:
                        i, j = np.nonzero(s >= floor[first:first + len(s), None])
                        found.append([i + first, s[i, j], none[j], ids[j]])
                top = [np.concatenate(x) for x in zip(*found)]
                keep = best(k, *top)
                top = [x[keep] for x in top]
                full = np.bincount(top[0], minlength=n_items) == k
                least = np.full(n_items, np.iinfo(np.int64).max)
                np.minimum.at(least, top[0], top[1])
                floor = np.where(full, least, 1)
        item, score, none, ids = top
        if len(item):
            yield pa.RecordBatch.from_arrays(
                [pa.array(item.astype(np.int32)), pa.array(ids, mask=none), pa.array(score)], ["item", "doc_id", "score"])
    return run


def search(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text: str = "text",
           item_col: str = "item_id", item_text: str = "text", pairs: int = PAIRS) -> DataFrame:
    """item_id, rank, doc_id, score of the ``k`` best documents of every item."""
    spark = docs.sparkSession
    src = docs.select(q(id_col).cast("long").alias("doc_id"), q(text).cast("string").alias("text"))
    asked = items.select(q(item_col).alias("item_id"), q(item_text).cast("string").alias("text"))
    kind = asked.schema["item_id"].dataType
    made = T.StructType([T.StructField("item_id", kind), T.StructField("term", T.LongType())])
    pair = written(asked.mapInArrow(_item_terms, made).distinct(), "item-terms")
    batches = -(-pair.count() // pairs)
    result = spark.createDataFrame([], T.StructType([
        T.StructField("item_id", kind), T.StructField("rank", T.IntegerType()),
        T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())]))
    for batch in range(batches):
        got = pair.where(F.pmod(F.xxhash64("item_id"), F.lit(batches)) == batch).toArrow()
        if got.num_rows:
            result = result.unionByName(_batch(src, got, k, kind))
    return result


def _batch(src: DataFrame, got: pa.Table, k: int, kind: T.DataType) -> DataFrame:
    spark = src.sparkSession
    coded = got["item_id"].combine_chunks().dictionary_encode(null_encoding="encode")
    ids, item = coded.dictionary, np.asarray(coded.indices).astype(np.int64)
    voc, term = np.unique(np.asarray(got["term"]).view(np.uint64), return_inverse=True)
    postings = written(src.mapInArrow(_postings(spark.sparkContext.broadcast(voc)),
                                      "doc_id long, n long, terms array<int>, tfs array<int>"), "postings")
    docs, length = postings.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    counted = postings.select(F.explode("terms").alias("t")).groupBy("t").count().toArrow()  # one row a term of the items
    df = np.zeros(len(voc), np.int64)
    df[np.asarray(counted["t"])] = np.asarray(counted["count"])
    weights = np.array([weight(docs, int(x)) if x else 0 for x in df], np.int64)
    sent = spark.sparkContext.broadcast({"ids": ids, "voc": voc, "docs": docs, "length": length or 1,
                                         "tiles": tiles(item, term, weights, len(ids))})

    hit = postings.where(F.size("terms") > 0)
    lists = (hit.mapInArrow(_ranked(sent, k), "item int, doc_id long, score long")
             .withColumn("part", F.spark_partition_id()))
    # a task's lists are k long; square root of the number of tasks meet first
    groups = max(1, math.isqrt(hit.rdd.getNumPartitions()))
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    lists = (lists.withColumn("salt", F.pmod("part", F.lit(groups)))
             .withColumn("rank", F.row_number().over(W.partitionBy("item", "salt").orderBy(*order))).where(F.col("rank") <= k))
    lists = lists.withColumn("rank", F.row_number().over(W.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)

    def named(batches):
        known = sent.value["ids"]
        for b in batches:
            yield pa.RecordBatch.from_arrays([known.take(b.column(0)), *b.columns[1:]], ["item_id", *b.schema.names[1:]])
    out = T.StructType([T.StructField("item_id", kind), T.StructField("rank", T.IntegerType()),
                        T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])
    return lists.select("item", "rank", "doc_id", "score").mapInArrow(named, out)
