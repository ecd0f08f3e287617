"""Toxicity by a convolutional text classifier, trained in numpy.

A word's embedding is the sum of two hashed rows: the word itself and its
first five bytes.  Filters of widths 1 to 3 run over the embeddings of a whole
text, each is max-pooled over all positions, and a logistic layer weighs the
pooled values.  The score is calibrated (Platt) on labelled rows left out of
the fit, and a threshold per language is chosen there; language, source and id
are never inputs of a score.

Fitted in one task from a bounded sample, so that the driver holds the model
only: the ``MAX_POS`` and ``MAX_NEG``
labelled ids that come first by a hash.  They are chosen on ids alone, and their
texts fetched by a join with those few keys.  Their words may be
``MAX_WORDS`` in all: each label has half of that, and what one leaves the
other may take; a text that does not fit is passed over and the next one tried.
Every text is scored whole.

Defined results: null, empty or wordless texts score as a text without any
filter active; repeated rows score alike; labels that are null, or whose row is
missing, are not learned from, nor are ids whose labels conflict; labels that
repeat count once; of rows that repeat an id one is learned from; with no labels of one kind, or no words in their
texts, the score is the share of toxic labels (0 if there are none); where all
texts of one label are too long the fit fails; no rows, no result.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm import textscan as TS
from starloom.llm.common import written

MAX_POS, MAX_NEG, MAX_WORDS = 1500, 2500, 1_500_000
BUCKETS, DIM, FILTERS = 1 << 16, 8, 8
WIDTHS = (1, 2, 3)
#: Updates that a fit makes at least: few labelled rows are gone through more often.
STEPS = 600


def _tokens(texts):
    """Rows lo:hi, words per row, and two hashed embedding rows per word."""
    off, data = TS.column(texts)
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + TS.CHUNK, "right")) - 1)
        a, b = int(off[lo]), int(off[hi])
        parts = [(a, b)] if b - a <= TS.CHUNK else list(TS._cuts(data, a, b))
        words, heads, counts = [], [], np.zeros(hi - lo, np.int64)
        for x, y in parts:
            seg = data[x:y]
            rel = off[lo:hi + 1] - a if len(parts) == 1 else np.array([0])
            start, end = TS.bounds(seg, rel)
            words.append(TS.hashes(seg, start, end))
            heads.append(TS.hashes(seg, start, np.minimum(end, start + 5)))
            counts += np.diff(np.searchsorted(start, rel)) if len(parts) == 1 else len(start)
        w, h = np.concatenate(words), np.concatenate(heads)
        m = np.uint64(BUCKETS - 1)
        yield lo, hi, counts, (w & m).astype(np.int64), ((h >> np.uint64(20)) & m).astype(np.int64)
        lo = hi


def _pooled(p, counts, w, h):
    """Pooled values, and for training where each maximum stands."""
    e = p["word"][w] + p["head"][h]
    has = counts > 0
    first = (np.cumsum(counts) - counts)[has]
    out, where = [], []
    for width in WIDTHS:
        z = np.zeros((len(e), FILTERS), np.float32)
        for j in range(width):
            z[:len(e) - j] += e[j:] @ p[f"f{width}"][j] if j < len(e) else 0
        for j in range(1, width):  # runs that would leave their text do not count
            at = (first + counts[has] - j)[counts[has] >= j]
            z[at] = -1.0
        v = np.zeros((len(counts), FILTERS), np.float32)
        if len(first):
            v[has] = np.maximum(np.maximum.reduceat(z, first, axis=0) + p[f"b{width}"], 0)
        out.append(v)
        where.append(z)
    return np.concatenate(out, axis=1), e, where


def train(samples: list[tuple[int, np.ndarray, np.ndarray]], epochs: int = 8, seed: int = 11) -> dict:
    """``samples``: (label, word rows, head rows) of each text."""
    rng = np.random.default_rng(seed)
    p = {"word": np.zeros((BUCKETS, DIM), np.float32), "head": np.zeros((BUCKETS, DIM), np.float32)}
    p["word"] += rng.normal(0, 0.02, p["word"].shape).astype(np.float32)
    p["head"] += rng.normal(0, 0.02, p["head"].shape).astype(np.float32)
    for width in WIDTHS:
        p[f"f{width}"] = rng.normal(0, 0.3, (width, DIM, FILTERS)).astype(np.float32)
        p[f"b{width}"] = np.zeros(FILTERS, np.float32)
    p["out"], p["bias"] = rng.normal(0, 0.3, FILTERS * len(WIDTHS)).astype(np.float32), np.zeros(1, np.float32)
    acc = {k: np.full(v.shape, 1e-6, np.float32) for k, v in p.items()}

    def update(name, grad, rows=None, rate=0.05):
        if rows is None:
            acc[name] += grad * grad
            p[name] -= rate * grad / np.sqrt(acc[name])
        else:
            u, inv = np.unique(rows, return_inverse=True)
            g = np.zeros((len(u), grad.shape[1]), np.float32)
            np.add.at(g, inv, grad)
            acc[name][u] += g * g
            p[name][u] -= rate * g / np.sqrt(acc[name][u])

    samples = [s for s in samples if len(s[1])]
    y_all = np.array([s[0] for s in samples], np.float32)
    weight = {1: 0.5 / max(y_all.mean(), 1e-6), 0: 0.5 / max(1 - y_all.mean(), 1e-6)}
    for _ in range(epochs):
        order = rng.permutation(len(samples))
        for at in range(0, len(order), 32):
            batch = [samples[i] for i in order[at:at + 32]]
            counts = np.array([len(s[1]) for s in batch])
            w, h = np.concatenate([s[1] for s in batch]), np.concatenate([s[2] for s in batch])
            y = np.array([s[0] for s in batch], np.float32)
            v, e, zs = _pooled(p, counts, w, h)
            prob = 1 / (1 + np.exp(-np.clip(v @ p["out"] + p["bias"], -30, 30)))
            d = (prob - y) * np.where(y > 0, weight[1], weight[0]).astype(np.float32) / len(batch)
            dv = d[:, None] * p["out"][None, :] * (v > 0)
            update("out", v.T @ d)
            update("bias", d.sum(keepdims=True))
            first = np.cumsum(counts) - counts
            rows, grads = [], []
            for k, width in enumerate(WIDTHS):
                dk = dv[:, k * FILTERS:(k + 1) * FILTERS]
                update(f"b{width}", dk.sum(0))
                best = np.stack([zs[k][a:a + c].argmax(0) + a for a, c in zip(first, counts)])
                fgrad = np.zeros_like(p[f"f{width}"])
                for j in range(width):
                    pos = np.minimum(best + j, len(e) - 1)
                    ok = (dk != 0) & (best + j < len(e))
                    g = np.where(ok, dk, 0)
                    fgrad[j] = np.einsum("bfd,bf->df", e[pos], g)
                    keep = ok.ravel()
                    rows.append(pos.ravel()[keep])
                    grads.append((g[:, :, None] * p[f"f{width}"][j].T[None]).reshape(-1, DIM)[keep])
                update(f"f{width}", fgrad)
            r, g = np.concatenate(rows), np.concatenate(grads)
            update("word", g, w[r])
            update("head", g, h[r])
    return p


def raw(p: dict, texts) -> np.ndarray:
    out = np.zeros(len(texts), np.float64)
    for lo, hi, counts, w, h in _tokens(texts):
        v, _, _ = _pooled(p, counts, w, h)
        out[lo:hi] = v @ p["out"] + p["bias"][0]
    return out


def _platt(s: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    a, b = 1.0, 0.0
    for _ in range(50):
        z = 1 / (1 + np.exp(-np.clip(a * s + b, -30, 30)))
        g = np.array([((z - y) * s).sum() + 1e-3 * (a - 1), (z - y).sum()])
        r = z * (1 - z) + 1e-9
        hess = np.array([[(r * s * s).sum() + 1e-3, (r * s).sum()], [(r * s).sum(), r.sum() + 1e-6]])
        step = np.clip(np.linalg.solve(hess, g), -1, 1)
        a, b = a - step[0], b - step[1]
    return (a, b) if a > 0 else (1.0, 0.0)


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, toxic, __sl_o) of the rows to learn from: of each label the
    first by a hash of the id, among ids that ``docs`` has.  Only ids are
    shuffled; the result has ``MAX_POS + MAX_NEG`` rows at most."""
    known = (labels.where(F.col("toxic").isin(0, 1)).groupBy("doc_id")
             .agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("__sl_hi"))
             .where((F.col("toxic") == F.col("__sl_hi")) & F.col("doc_id").isNotNull()).drop("__sl_hi"))
    there = known.join(docs.select("doc_id"), "doc_id", "left_semi").withColumn("__sl_o", F.xxhash64(F.col("doc_id").cast("string")))
    return there.where("toxic = 1").orderBy("__sl_o", "doc_id").limit(MAX_POS).unionByName(
        there.where("toxic = 0").orderBy("__sl_o", "doc_id").limit(MAX_NEG))


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    """Model from (doc_id, text, lang) and (doc_id, toxic), fitted in one task,
    which reads the sample's texts and no others."""
    pick = written(sample(docs, labels), "sample")
    # at most MAX_POS + MAX_NEG keys; of rows that repeat an id, one text, chosen by its hash
    rows = docs.select("doc_id", "lang", "text").join(F.broadcast(pick), "doc_id")
    one = rows.groupBy("doc_id", "toxic", "__sl_o").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text", "lang")).alias("r"))
    rows = one.select("toxic", "r.lang", "r.text", "__sl_o", "doc_id").orderBy("__sl_o", "doc_id")

    def run(batches):
        got = [b for b in batches if b.num_rows]
        if got:
            model = pickle.dumps(_fitted(pa.Table.from_batches(got)))
            yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], ["model"])
    made = rows.coalesce(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(made[0]["model"]) if made else {"share": 0.0}


def _fitting(turn, y, words, most: int | None = None) -> list[int]:
    """Rows in the order of ``turn`` whose words fit: half of ``most`` for each
    label, then what is left for any."""
    most = MAX_WORDS if most is None else most
    use, left = set(), 0
    for label in (0, 1):
        room = most // 2
        for i in turn:
            if y[i] == label and words[i] <= room:
                room -= words[i]
                use.add(i)
        left += room
    for i in turn:
        if i not in use and words[i] <= left:
            left -= words[i]
            use.add(i)
    return [i for i in turn if i in use]


def _fitted(rows: pa.Table) -> dict:
    """Model from the sample's rows, in the order of their ids' hashes."""
    y, lang = np.asarray(rows["toxic"]).astype(int), rows["lang"].to_pylist()
    if len(y) == 0 or y.min() == y.max():
        return {"share": float(y.mean()) if len(y) else 0.0}
    turn = np.argsort(np.asarray(rows["__sl_o"]), kind="stable")
    samples: list = [None] * len(y)
    for lo, hi, counts, w, h in _tokens(rows["text"]):
        ends = np.cumsum(counts)
        for i in range(lo, hi):
            a, b = ends[i - lo] - counts[i - lo], ends[i - lo]
            samples[i] = (y[i], w[a:b], h[a:b])
    use = _fitting(turn, y, [len(s[1]) for s in samples])
    held = [i for n, i in enumerate(use) if n % 4 == 0]
    part = [i for n, i in enumerate(use) if n % 4]
    learned = lambda rows: {y[i] for i in rows if len(samples[i][1])}
    if len(learned(part)) < 2:  # few rows: none of a label is left out
        part = use
    if len(learned(part)) < 2:
        if len(use) < len(y):
            raise ValueError(f"no labelled texts of both kinds within {MAX_WORDS} words")
        return {"share": float(y.mean())}
    p = train([samples[i] for i in part], epochs=max(8, -(-STEPS * 32 // max(len(part), 1))))
    s = np.array([_score1(p, samples[i]) for i in held])
    yh = np.array([y[i] for i in held])
    a, b = _platt(s, yh) if len(held) and yh.min() != yh.max() else (1.0, 0.0)
    p["platt"] = (a, b)
    prob = 1 / (1 + np.exp(-np.clip(a * s + b, -30, 30)))
    p["by_lang"] = {}
    for name in {lang[i] for i in held}:  # the threshold that errs least, 0.7 where it makes no odds
        mine = np.array([lang[i] == name for i in held])
        tries = np.array([0.7, 0.5, 0.6, 0.8, 0.9])
        wrong = [((prob[mine] >= t) != yh[mine]).sum() for t in tries]
        p["by_lang"][name] = float(tries[int(np.argmin(wrong))])
    return p


def _score1(p, sample) -> float:
    v, _, _ = _pooled(p, np.array([len(sample[1])]), sample[1], sample[2])
    return float(v[0] @ p["out"] + p["bias"][0])


def score(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1); a column of that name is replaced."""
    spark = docs.sparkSession
    docs = docs.drop("score")
    sent = spark.sparkContext.broadcast(model)
    names = docs.columns
    at = names.index(text)

    def run(batches):
        m = sent.value
        for b in batches:
            t = b.column(at).cast(pa.string())
            if "share" in m:
                s = np.full(len(t), m["share"])
            else:
                a, c = m["platt"]
                s = 1 / (1 + np.exp(-np.clip(a * raw(m, t) + c, -30, 30)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s)], [*names, "score"])

    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())])
    return docs.mapInArrow(run, schema)


def held_out(col):
    """Rows no label is learned from."""
    return F.coalesce(F.crc32(col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def trained(docs: DataFrame, labels: DataFrame) -> dict:
    return fit(docs, labels.select("doc_id", "toxic").where(~held_out(F.col("doc_id"))))


def threshold(model: dict, lang):
    """The language's threshold (0.7 for one not met in the fit)."""
    out = F.lit(0.7)
    for name, t in (model.get("by_lang") or {}).items():
        out = F.when(lang == F.lit(name), F.lit(t)).otherwise(out)
    return out
