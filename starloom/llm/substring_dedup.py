"""Substring dedup by difference-cover anchors.

Positions of a text that are in a difference cover modulo ``PERIOD`` carry an
anchor, the hash of the words from there on.  For any two positions some shift
below the period puts both on cover positions, so any two equal windows share
an aligned anchor; an anchor spans ``size - PERIOD + 1`` words and lies inside
both.  Only windows around anchors that occur again are hashed whole (the
extension), and those that occur again are removed.

Keys are first held against each other within a block of texts (2 MB): what
occurs again there is settled, and a key is sent once a block, so that a
passage that a third of all texts hold costs its bucket one entry a block, not
one a text.  Blocks send their keys packed, by range of the hash; a bucket's
task tells which keys came more than once.  No pair of positions is formed.

Defined results: null and wordless texts have no words and the digest of the
empty text; texts shorter than the window stay whole; repeated rows repeat each
other's windows, so both lose them; an empty table gives an empty result; rows
are told apart by a 64-bit hash of doc_id and text, other columns play no part.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm import textscan as TS
from starloom.llm.common import free_shuffles, q, written
from starloom.llm.packed import dealt, lists, pack, steps, unpack

SIZE, PERIOD = 35, 21
COVER = (3, 6, 7, 12, 14)  # every difference modulo 21 occurs
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


#: Buckets of keys: at least so many, and one more per so many bytes of text.
BUCKETS, BUCKET_BYTES = 48, 32 << 20
_ASKED = "bucket int, asked boolean, docs array<long>, body binary"


def _ask(keys, buckets: int):
    """Blocks of keys by bucket.  ``keys`` gives hash, row and position of each
    key of a block, and the rows' document keys."""
    width = np.uint64((1 << 64) // buckets + 1)
    edges = np.arange(1, buckets, dtype=np.uint64) * width

    def run(batches):
        for b in batches:
            for h, row, pos, doc in keys(b):
                if not len(h):
                    continue
                order = np.argsort(h, kind="stable")
                h, row, pos = h[order], row[order], pos[order].astype(np.uint32)
                other = h[1:] != h[:-1]
                first = np.concatenate([[True], other])
                lone = first & np.concatenate([other, [True]])
                out = []
                if not lone.all():  # again within the block
                    u, r = np.unique(row[~lone], return_inverse=True)
                    # settled: any bucket will do, so blocks are spread by their documents
                    out.append((int(doc[u].sum()) % buckets, False, doc[u], pack(r.astype(np.uint32), pos[~lone])))
                hs, rs, ps, ls = h[first], row[first], pos[first], lone[first]
                cuts = np.concatenate([[0], np.searchsorted(hs, edges), [len(hs)]])
                for i in np.flatnonzero(np.diff(cuts)):
                    at = slice(cuts[i], cuts[i + 1])
                    u, r = np.unique(rs[at][ls[at]], return_inverse=True)
                    rr = np.full(cuts[i + 1] - cuts[i], len(u), np.uint32)  # settled keys point past the documents
                    rr[ls[at]] = r
                    out.append((int(i), True, doc[u], pack(steps(hs[at]), rr, ps[at])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out]),
                     lists(pa.array(np.concatenate([x[2] for x in out])), np.array([len(x[2]) for x in out])),
                     pa.array([x[3] for x in out], pa.binary())], ["bucket", "asked", "docs", "body"])
    return run


def _found(doc, row, pos):
    order = np.argsort(row, kind="stable")
    row = row[order]
    first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    return pa.RecordBatch.from_arrays(
        [pa.array(doc[row[first]]), lists(pa.array(pos[order].astype(np.int32)), np.diff(np.append(first, len(row))))], ["doc", "at"])


def _tell(batches):
    """Positions of the keys that occur again, from a bucket's blocks."""
    bucket, blocks = None, []

    def told():
        got = [unpack(body, np.uint64, np.uint32, np.uint32) for _, body in blocks]
        hs = [np.cumsum(g[0], dtype=np.uint64) for g in got]
        all_ = np.sort(np.concatenate([x for h, g, (doc, _) in zip(hs, got, blocks) for x in (h, h[g[1] == len(doc)])]))
        again = np.unique(all_[1:][all_[1:] == all_[:-1]])
        if len(again):
            for h, (_, row, pos), (doc, _) in zip(hs, got, blocks):
                at = np.minimum(np.searchsorted(again, h), len(again) - 1)
                on = (again[at] == h) & (row < len(doc))
                if on.any():
                    yield _found(doc, row[on], pos[on])

    for b in batches:
        for i in range(b.num_rows):
            here = b.column(0)[i].as_py()
            if here != bucket and blocks:
                yield from told()
                blocks = []
            bucket = here
            doc, body = b.column(2)[i].values.to_numpy(zero_copy_only=False), b.column(3)[i].as_buffer().to_pybytes()
            if b.column(1)[i].as_py():
                blocks.append((doc, body))
            else:
                yield _found(doc, *unpack(body, np.uint32, np.uint32))
    if blocks:
        yield from told()


def _again(rows: DataFrame, keys, buckets: int, what: str) -> DataFrame:
    """Positions whose key occurs more than once, gathered per document."""
    told = dealt(rows.mapInArrow(_ask(keys, buckets), _ASKED), buckets).mapInArrow(_tell, "doc long, at array<int>")
    out = written(told.groupBy("doc").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_set("at")))).alias("at")), what)
    free_shuffles(rows.sparkSession)
    return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and the text that is kept, per row."""
    if size <= PERIOD:
        raise ValueError(f"windows must be longer than {PERIOD} words")
    kind = docs.schema[id_col].dataType.simpleString()
    t = q(text).cast("string")
    src = docs.select(q(id_col).alias("doc_id"), F.xxhash64(q(id_col), F.xxhash64(t)).alias("doc"), t.alias("text"))
    span = size - PERIOD + 1
    total = src.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = max(BUCKETS, -(-total // BUCKET_BYTES))
    covered = np.isin(np.arange(PERIOD), COVER)

    def anchors(b):
        doc = np.asarray(b.column(0))
        for lo, hi, counts, h in TS.words(b.column(1), fold=False):
            per, s = TS.windows(counts, h, span)
            row = np.repeat(np.arange(lo, hi), per)
            pos = np.arange(len(s)) - np.repeat(np.cumsum(per) - per, per)
            on = covered[pos % PERIOD]
            yield s[on], row[on], pos[on], doc

    def extended(b):
        doc, found = np.asarray(b.column(0)), b.column(2)
        for lo, hi, counts, h in TS.words(b.column(1), fold=False):
            per, s = TS.windows(counts, h, size)
            first = np.cumsum(per) - per
            near = np.zeros(len(s) + 1, np.int64)
            for i in range(lo, hi):
                n, f = per[i - lo], first[i - lo]
                if n:
                    p = found[i].values.to_numpy(zero_copy_only=False)
                    a, z = np.clip(p - PERIOD + 1, 0, n), np.clip(p + 1, 0, n)
                    np.add.at(near, f + a, 1)
                    np.add.at(near, f + z, -1)
            on = np.cumsum(near)[:-1] > 0
            row = np.repeat(np.arange(lo, hi), per)
            pos = np.arange(len(s)) - np.repeat(first, per)
            yield s[on], row[on], pos[on], doc

    def cut(batches):
        for b in batches:
            n_words, n_removed, digest, kept = [], [], [], []
            for i, t_ in enumerate(b.column(1).to_pylist()):
                at = b.column(2)[i].values
                words = _WORD.findall((t_ or "").encode())
                n_words.append(len(words))
                if at is not None and len(at):
                    gone = np.zeros(len(words) + 1, np.int64)
                    p = at.to_numpy(zero_copy_only=False)
                    np.add.at(gone, p, 1)
                    np.add.at(gone, p + size, -1)
                    stay = np.cumsum(gone)[:-1] == 0
                    words = [w for w, k in zip(words, stay) if k]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words))
                digest.append(hashlib.sha256(kept[-1]).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digest, pa.string()),
                 pa.array([k.decode() for k in kept], pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    around = _again(src.select("doc", "text"), anchors, buckets, "anchors")
    repeats = _again(src.select("doc", "text").join(around, "doc").select("doc", "text", "at"), extended, buckets, "repeats")
    return src.join(repeats, "doc", "left").select("doc_id", "text", "at").mapInArrow(
        cut, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string, kept string")
