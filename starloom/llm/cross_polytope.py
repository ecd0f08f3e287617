"""Approximate nearest neighbours by cross-polytope hashing.

Unit vectors, padded to a power of two, pass three rounds of random signs and a
fast Hadamard transform; the nearest signed axis is the bucket, one per table.
A query probes the ``PROBES`` nearest signed axes of every table and is held
against the original vectors it finds, in double precision.  Every row is
indexed, equal rows (id and vector) once.  Buckets are cut by a salt so that a
piece holds about ``PIECE`` rows, and of equal vectors only the ``k + 1`` least
ids are kept, which is exact for the k nearest with ties to the lesser id (a
bucket of copies costs no more).  A bucket's k best are k ids, each at its best.

Defined results: vectors that are null, zero, or hold null or non-finite
components, and null ids, take no part; fewer than k other vectors give what
was found; repeated ids count once, at their best score; vectors of another
length than the first are refused; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from starloom.llm.common import q, written

K, TABLES, PROBES, PIECE = 20, 3, 48, 4096


def rotate(x: np.ndarray, seed: int) -> np.ndarray:
    """Pseudo-rotation of the rows of ``x``."""
    d = 1 << max(0, int(x.shape[1] - 1).bit_length())
    y = np.zeros((len(x), d))
    y[:, :x.shape[1]] = x
    rng = np.random.default_rng(seed)
    for _ in range(3):
        y = y * rng.choice([-1.0, 1.0], d)
        h = 1
        while h < d:
            y = y.reshape(len(x), d // (2 * h), 2, h)
            y = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(len(x), d)
            h *= 2
        y /= np.sqrt(d)
    return y


def _matrix(col) -> np.ndarray:
    n = len(col)
    return np.asarray(col.flatten(), dtype=np.float64).reshape(n, -1) if n else np.zeros((0, 0))


def _axes(x: np.ndarray, table: int, probes: int) -> np.ndarray:
    y = rotate(x / np.linalg.norm(x, axis=1, keepdims=True), 1000 + table)
    return np.argsort(-np.concatenate([y, -y], axis=1), axis=1, kind="stable")[:, :probes]


def _hashed(probes: int, tables: int):
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b.column(1))
            for t in range(tables):
                a = _axes(x, t, probes)
                at = pa.array(np.repeat(np.arange(len(a)), a.shape[1]))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(at), b.column(1).take(at), pa.array(np.full(a.size, t, np.int32)), pa.array(a.ravel().astype(np.int32))],
                    ["vec_id", "embedding", "t", "axis"])
    return run


def nearest(vecs: DataFrame, every: int = 20, k: int = K, tables: int = TABLES, probes: int = PROBES) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest found of each row whose
    vec_id is divisible by ``every``."""
    e = F.col("embedding")
    ok = F.size(e) > 0
    whole = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    v = written(vecs.select(q("vec_id").cast("long").alias("vec_id"), q("embedding").cast("array<double>").alias("embedding"))
                .where(F.col("vec_id").isNotNull() & ok & whole & F.exists(e, lambda x: x != 0)).distinct(), "vectors")
    nth = F.row_number().over(W.partitionBy("embedding").orderBy("vec_id"))
    index = v.withColumn("nth", nth).where(F.col("nth") <= k + 1).drop("nth")
    shape = "vec_id long, embedding array<double>, t int, axis int"
    salts = max(1, -(-v.count() // (128 * PIECE)))
    put = index.mapInArrow(_hashed(1, tables), shape).withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(salts)).cast("int"))
    ask = (v.where(F.col("vec_id") % every == 0).mapInArrow(_hashed(probes, tables), shape)
           .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))))

    def rank(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"query_id": [], "vec_id": [], "score": []}
        if left.num_rows and right.num_rows:
            qi, qx = np.asarray(left["vec_id"]), _matrix(left["embedding"].combine_chunks())
            vi, vx = np.asarray(right["vec_id"]), _matrix(right["embedding"].combine_chunks())
            order = np.argsort(vi, kind="stable")
            ids, first = np.unique(vi[order], return_index=True)
            repeated, vi = len(ids) < len(vi), ids
            vx = vx[order]
            for lo in range(0, len(qi), 256):
                s = qx[lo:lo + 256] @ vx.T
                if repeated:
                    s = np.maximum.reduceat(s, first, axis=1)
                s[qi[lo:lo + 256, None] == vi[None, :]] = -np.inf
                for i in range(len(s)):
                    r = s[i]
                    best = np.flatnonzero(r >= (np.partition(r, len(r) - k)[len(r) - k] if len(r) > k else -np.inf))
                    best = best[r[best] > -np.inf]
                    best = best[np.lexsort((vi[best], -r[best]))][:k]
                    out["query_id"].append(np.full(len(best), qi[lo + i]))
                    out["vec_id"].append(vi[best])
                    out["score"].append(r[best])
        return pa.table({c: pa.array(np.concatenate(a) if a else np.zeros(0), pa.float64() if c == "score" else pa.int64()) for c, a in out.items()})

    key = ["t", "axis", "salt"]
    found = (ask.groupBy(*key).cogroup(put.groupBy(*key)).applyInArrow(rank, "query_id long, vec_id long, score double")
             .groupBy("query_id", "vec_id").agg(F.max("score").alias("score")))
    order = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", order).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
