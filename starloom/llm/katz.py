"""Language-model scoring by Katz backoff over bigrams.

Counts of words and of word pairs come from the training rows.  Good-Turing
discounts counts up to ``CUT`` (a count whose discount would not lie between 0
and 1 keeps 0.5).  What the discounts free goes to words never seen (one class)
at the lower order, and at the higher order to words not seen after a history,
in proportion to their lower-order probability; the backoff weight normalises
this exactly.  Every token is scored recursively: the pair, else weight and
word, else the class of unseen words.

Words, with their counts, are a table of one row a word.  Up to ``WORDS`` words
it is broadcast, of more words the most frequent ones, at most half as many.
Words sent are numbered, pairs of two such words are one number, and:

* pair counts are added up in each task, then by bucket of the pair's hash,
  and stored as a table of packed blocks of ``BLOCK`` pairs of a bucket: tasks
  unpack and work on one block at a time;
* a text's tokens are scored with the weight and word, which are known where
  the text is; the pairs that the model may hold are sent to their bucket,
  packed by block of texts, which returns what the score changes by;
* the most frequent pairs (a hundred-thousandth of all tokens or more, so
  100,000 pairs at most) are broadcast and never sent: no bucket gets an entry
  a text for them.

A word that was not sent is known by its hash.  A token that is one, or follows
one, is an entry (word, other word, text) in the bucket of that word's hash, as
word, as history, or as both in two buckets; texts held out send theirs too.  So
the bucket of a word has all of its tokens and all that follow it: from them it
knows its count, what it keeps as a history and, once the other buckets have
told it the shares of words not sent that follow it, its weight.  Text and
buckets each add the part of a token's score that they know; results are the
same up to the order of sums.

Defined results: null text is the empty text, one end token; with no training
rows every score comes from the unseen class; repeated rows (same id and text)
are scored alike and each is returned; null ids count as training rows (their
remainder is unknown); an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm import textscan as TS
from starloom.llm.common import free_shuffles, q, written
from starloom.llm.packed import dealt, lists, pack, steps, unpack

CUT = 5
#: Words up to which their table is broadcast (20 bytes a word); of more, the most frequent half of it.
WORDS = 1 << 21
#: Buckets of pairs: at least so many, and one more per so many training tokens.
BUCKETS, BUCKET_TOKENS = 48, 12_000_000
#: Pairs of a block of their table.
BLOCK = 1 << 18
#: Pair counts a task holds before it sends or adds them (about 50 bytes each meanwhile).
_HELD = 1_000_000
#: Histories of a batch.
_ROWS = 1 << 16
_END, _START = 1, 2
#: Bits that words' hashes are looked up by first.
_BEGIN = 21
#: Bits of an entry of a word not sent: the other word was not sent either, it is the history, its text is held out.
_BOTH, _HIST, _HELD_OUT = 1, 2, 4


def good_turing(n: dict[int, int]) -> list[float]:
    """Factor for counts 1 to CUT, by Katz's rule, from how many have each count."""
    out, n1 = [], n.get(1, 0)
    tail = (CUT + 1) * n.get(CUT + 1, 0) / n1 if n1 else 0.0
    for r in range(1, CUT + 1):
        d = 0.5
        if n.get(r) and n.get(r + 1) and tail < 1:
            d = ((r + 1) * n[r + 1] / (r * n[r]) - tail) / (1 - tail)
        out.append(d if 0 < d < 1 else 0.5)
    return out


def _kept(c: np.ndarray, d: list[float]) -> np.ndarray:
    """Discounted counts."""
    return c * np.append(d, 1.0)[np.minimum(c, CUT + 1).astype(np.int64) - 1]


def _words(batches):
    for b in batches:
        for lo, hi, _, h in TS.words(b.column(0)):
            w, c = np.unique(h.view(np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(w, _END)), pa.array(np.append(c, hi - lo))], ["w", "c"])


def _some(c: np.ndarray) -> np.ndarray:
    """How many have each count up to CUT + 1."""
    return np.bincount(c[c <= CUT + 1], minlength=CUT + 2)


class _Words:
    """Numbers of the words sent, in the order of their hashes, and what is known
    of each.  ``whole`` tells of all words where not all are sent: how many have
    each count up to CUT + 1, the tokens and the words."""

    def __init__(self, w: np.ndarray, c: np.ndarray, whole: tuple[np.ndarray, int, int] | None = None):
        order = np.argsort(w)
        self.v, self.all = len(w), whole is None
        some, self.n, self.size = whole or (_some(c), int(c.sum()), len(w))
        self.w, c = w[order], np.append(c[order], 0)  # the last stands for words not seen
        self.c = c.astype(np.uint32) if self.n < 1 << 32 else c
        self.d = good_turing(dict(enumerate(some.tolist())))
        freed = sum(int(some[r]) * r * (1.0 - self.d[r - 1]) for r in range(1, CUT + 1))
        self.none = max(freed / max(self.n, 1), 1e-12) if self.n else 1.0
        self._first = None

    def share(self, c: np.ndarray) -> np.ndarray:
        """Lower-order probability of words with counts ``c``."""
        return np.where(c > 0, _kept(np.maximum(c, 1), self.d) / max(self.n, 1), self.none)

    def base(self, c: np.ndarray) -> np.ndarray:
        """Base score of words with counts ``c``."""
        return np.log10((c + 1) / float(self.n + self.size + 1))

    def p(self, word: np.ndarray) -> np.ndarray:
        """Lower-order probability."""
        return self.share(self.c[word].astype(np.int64))

    def follow(self, hist: np.ndarray) -> np.ndarray:
        """Training tokens after a history: its own count, as every word has a
        token after it; the number of texts for their start."""
        texts = self.c[self.ids(np.array([_END]))[0]]
        return np.where(hist < self.v, self.c[np.minimum(hist, self.v)], np.where(hist == self.v, texts, 0)).astype(np.int64)

    def ids(self, h: np.ndarray) -> np.ndarray:
        """Number of each word; v for one that is not here."""
        if self._first is None:  # of the words that begin with the same bits, the first
            begin = np.cumsum(np.bincount(self._begin(self.w), minlength=1 << _BEGIN))
            self._first = np.append(0, begin).astype(np.int32 if self.v < 1 << 31 else np.int64)
        begin = self._begin(h)
        at, end = self._first[begin], self._first[begin + 1]
        out = np.full(len(h), self.v)
        left = np.flatnonzero(at < end)
        at, end, h = at[left], end[left], h[left]
        while len(left):
            hit = self.w[at] == h
            out[left[hit]] = at[hit]
            at = at + 1
            go = ~hit & (at < end)
            left, at, end, h = left[go], at[go], end[go], h[go]
        return out

    @staticmethod
    def _begin(h: np.ndarray) -> np.ndarray:
        return (h >> (64 - _BEGIN)) + (1 << (_BEGIN - 1))

    def pairs(self, counts: np.ndarray, h: np.ndarray):
        """Text, history and word of each token of a block.  Words: v is one not
        seen, or not sent.  Histories: v is the start of a text, v + 1 such a word."""
        x = self.ids(h.view(np.int64))
        ends = np.cumsum(counts)
        end = int(self.ids(np.array([_END]))[0])
        word = np.insert(x, ends, end)
        hist = np.insert(np.where(x == self.v, self.v + 1, x), ends - counts, self.v)
        return np.repeat(np.arange(len(counts)), counts + 1), hist, word


def _bucket(key: np.ndarray, buckets: int) -> np.ndarray:
    return (TS.mix(key.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def _slices(sorted_: np.ndarray):
    at = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]])) if len(sorted_) else np.zeros(0, np.int64)
    return zip(at, np.append(at[1:], len(sorted_)))


def _added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts.  Empties the lists,
    so that what they hold can go meanwhile."""
    k = np.concatenate(keys)
    keys.clear()
    order = np.argsort(k)
    k = k[order]
    c = np.concatenate(counts)[order]
    counts.clear()
    del order
    first = np.flatnonzero(np.append(True, k[1:] != k[:-1])[:len(k)])
    return k[first], np.add.reduceat(c, first)


def _by_bucket(keys: list[np.ndarray], counts: list[np.ndarray], buckets: int) -> list[tuple[int, bytes]]:
    """Pair counts added up and packed by bucket.  Empties the lists."""
    u, c = _added(keys, counts)
    b = _bucket(u, buckets)
    order = np.argsort(b.astype(np.uint16) if buckets <= 1 << 16 else b, kind="stable")
    u, c, b = u[order], c[order], b[order]
    del order
    return [(int(b[x]), pack(steps(u[x:y]), c[x:y])) for x, y in _slices(b)]


def _count_pairs(sent, buckets: int):
    """Pair counts of the texts of a task, by bucket."""
    def run(batches):
        words = sent.value
        keys, counts, held = [], [], 0

        def out():
            rows = _by_bucket(keys, counts, buckets)
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["bucket", "body"])

        for batch in batches:
            for _, _, per, h in TS.words(batch.column(0)):
                _, hist, word = words.pairs(per, h)
                u, c = np.unique(hist * (words.v + 1) + word, return_counts=True)
                keys.append(u)
                counts.append(c)
                held += len(u)
                if held > _HELD:
                    yield out()
                    held = 0
        if keys:
            yield out()
    return run


def _four(rows) -> pa.RecordBatch:
    """Rows of bucket, part, docs and body."""
    docs = [r[2] for r in rows]
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
                                       lists(pa.array(np.concatenate(docs) if docs else np.zeros(0, np.int64)), np.array([len(x) for x in docs], np.int64)),
                                       pa.array([r[3] for r in rows], pa.binary())], ["bucket", "part", "docs", "body"])


_FOUR = "bucket int, part int, docs array<long>, body binary"
_NO_DOCS = np.zeros(0, np.int64)


def _count_all(sent, buckets: int):
    """Of the texts of a task, by bucket: counts of the training pairs of words
    sent, and the entries of the other words."""
    def run(batches):
        words = sent.value
        keys, counts, held = [], [], 0
        top = lambda: _four([(b, 0, _NO_DOCS, body) for b, body in _by_bucket(keys, counts, buckets)])
        for batch in batches:
            ids, apart = np.asarray(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for lo, hi, per, h in TS.words(batch.column(2)):
                text, hist, word = words.pairs(per, h)
                here = (word < words.v) & (hist <= words.v) & ~apart[lo:hi][text]
                u, c = np.unique(hist[here] * (words.v + 1) + word[here], return_counts=True)
                keys.append(u)
                counts.append(c)
                held += len(u)
                yield _four(_entries(words.v, per, h.view(np.int64), text, hist, word, apart[lo:hi], ids[lo:hi], buckets))
                if held > _HELD:
                    yield top()
                    held = 0
        if keys:
            yield top()
    return run


def _entries(v: int, per, h, text, hist, word, apart, doc, buckets: int):
    """Rows with the entries of the words not sent, by bucket: word, other word,
    text, how often, and bits."""
    ends = np.cumsum(per)
    as_word, as_hist = np.flatnonzero(word == v), np.flatnonzero(hist == v + 1)
    hash_w, hash_h = np.insert(h, ends, _END), np.insert(h, ends - per, _START)
    r = np.concatenate([hash_w[as_word], hash_h[as_hist]])
    both = np.concatenate([hist[as_word] == v + 1, word[as_hist] == v])
    other = np.where(both, np.concatenate([hash_h[as_word], hash_w[as_hist]]), np.concatenate([hist[as_word], word[as_hist]]))
    t = np.concatenate([text[as_word], text[as_hist]])
    bits = both * _BOTH + np.repeat([0, _HIST], [len(as_word), len(as_hist)]) + apart[t] * _HELD_OUT
    bucket = _bucket(r, buckets)
    order = np.lexsort((t, other, bits, r, bucket))
    r, other, t, bits, bucket = (x[order] for x in (r, other, t, bits, bucket))
    first = np.flatnonzero(np.concatenate([[True], (r[1:] != r[:-1]) | (other[1:] != other[:-1]) | (t[1:] != t[:-1]) | (bits[1:] != bits[:-1])])[:len(r)])
    times = np.diff(np.append(first, len(r)))
    r, other, t, bits, bucket = (x[first] for x in (r, other, t, bits, bucket))
    rows = []
    for x, y in _slices(bucket):
        u, row = np.unique(t[x:y], return_inverse=True)
        rows.append((int(bucket[x]), 1, doc[u], _packed_entries(r[x:y], other[x:y], row, times[x:y], bits[x:y])))
    return rows


def _packed_entries(r, other, row, times, bits) -> bytes:
    return pack(steps(r), other, row.astype(np.uint32), times.astype(np.uint32), bits.astype(np.uint32))


def _unpacked_entries(body: bytes) -> list[np.ndarray]:
    r, other, *rest = unpack(body, np.int64, np.int64, np.uint32, np.uint32, np.uint32)
    return [np.cumsum(r), other, *(x.astype(np.int64) for x in rest)]


class _Entries:
    """A block of entries, in the order of word, role, other word and text; it
    has all entries of its words."""

    def __init__(self, body: bytes):
        r, other, self.row, self.times, bits = _unpacked_entries(body)
        kind = bits & (_BOTH | _HIST)
        new = np.append(True, (r[1:] != r[:-1]) | (kind[1:] != kind[:-1]))
        first = np.flatnonzero(np.append(True, new[1:] | (other[1:] != other[:-1])))
        #: Of each entry its pair; of each pair the words, its kind and training count.
        self.pair = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(r))))
        self.r, self.other = r[first], other[first]
        self.both, self.hist = (kind[first] & _BOTH) > 0, (kind[first] & _HIST) > 0
        self.c = np.add.reduceat(np.where(bits & _HELD_OUT, 0, self.times), first)
        #: Of each pair its word and role, and of these the training count.
        new = np.append(True, (self.r[1:] != self.r[:-1]) | (self.hist[1:] != self.hist[:-1]))
        self.role, self.role_first = np.cumsum(new) - 1, np.flatnonzero(new)
        self.count = np.add.reduceat(self.c, self.role_first)[self.role]

    def of_texts(self, values: np.ndarray, n: int) -> np.ndarray:
        """Sums of the pairs' values over each of ``n`` texts."""
        return np.bincount(self.row, values[self.pair] * self.times, n)


def _add_all(batches):
    """Blocks of the pairs of words sent, as ``_add_pairs`` has them, and blocks of the other words' entries."""
    rest: dict[int, list] = {}

    def top():
        for b in batches:
            part = np.asarray(b.column(1))
            for i in np.flatnonzero(part == 1):
                rest.setdefault(b.column(0)[i].as_py(), []).append((np.array(b.column(2)[i].values), b.column(3)[i].as_buffer().to_pybytes()))
            mine = pa.array(part == 0)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(mine), b.column(3).filter(mine)], ["bucket", "body"])

    def five(rows, some):
        four = _four(rows)
        return pa.RecordBatch.from_arrays([*four.columns, some], [*four.schema.names, "some"])

    for b in _add_pairs(top()):
        yield five([(k, 0, _NO_DOCS, body) for k, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist())], b.column(2))
    for bucket, rows in rest.items():
        got = [_unpacked_entries(body) for _, body in rows]
        at = np.cumsum([0] + [len(d) for d, _ in rows])
        docs = np.concatenate([d for d, _ in rows])
        for x, a in zip(got, at):
            x[2] += a
        rows.clear()
        r, other, row, times, bits = (np.concatenate(x) for x in zip(*got))
        del got
        order = np.lexsort((row, other, bits & (_BOTH | _HIST), r))
        r, other, row, times, bits = (x[order] for x in (r, other, row, times, bits))
        first = np.flatnonzero(np.append(True, r[1:] != r[:-1]))
        # a block has all entries of its words
        cut = np.unique(np.append(first[np.searchsorted(first, np.arange(0, r.size, BLOCK), "right") - 1], r.size))
        for x, y in zip(cut, cut[1:]):
            u, own = np.unique(row[x:y], return_inverse=True)
            body = _packed_entries(r[x:y], other[x:y], own, times[x:y], bits[x:y])
            e = _Entries(body)
            some = _some(e.c[(e.hist | ~e.both) & (e.c > 0)])  # a pair of two such words counts where it is the history's
            yield five([(bucket, 1, docs[u], body)], pa.array([some.tolist()], pa.list_(pa.int64())))


def _add_pairs(batches):
    """Blocks of the pairs of a bucket: pairs and counts, and how many have each count up to CUT + 1."""
    bucket, keys, counts, new = None, [], [], 0

    def out():
        u, c = _added(keys, counts)
        for x in range(0, len(u), BLOCK):
            k, n = u[x:x + BLOCK], c[x:x + BLOCK]
            some = _some(n)
            yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([pack(steps(k), n)], pa.binary()),
                                              pa.array([some.tolist()], pa.list_(pa.int64()))], ["bucket", "body", "some"])

    for b in batches:
        for i in range(b.num_rows):
            here = b.column(0)[i].as_py()
            if here != bucket and keys:
                yield from out()
                new = 0
            bucket = here
            k, c = unpack(b.column(1)[i].as_buffer().to_pybytes(), np.int64, np.int64)
            keys.append(np.cumsum(k))
            counts.append(c)
            new += len(k)
            if new > _HELD:
                u, c = _added(keys, counts)
                keys, counts, new = [u], [c], 0
    if keys:
        yield from out()


def _histories(sent, d: list[float]):
    """Count, discounted count and lower-order share of each history, of a task's pairs."""
    def run(batches):
        words = sent.value
        sums = np.zeros((2, words.v + 1))
        for b in batches:
            part = np.asarray(b.column(1)) if b.num_columns > 1 else np.zeros(b.num_rows, np.int32)
            for body, entries in zip(b.column(0), part):
                if entries:
                    e = _Entries(body.as_buffer().to_pybytes())
                    on = ~e.hist & ~e.both & (e.c > 0)
                    for x, values in zip(sums, (_kept(e.c[on], d), words.share(e.count[on]))):
                        np.add.at(x, e.other[on], values)
                    continue
                k, c = unpack(body.as_buffer().to_pybytes(), np.int64, np.int64)
                hist, word = np.divmod(np.cumsum(k), words.v + 1)
                first = np.flatnonzero(np.append(True, hist[1:] != hist[:-1]))  # pairs are in the order of their histories
                for x, values in zip(sums, (_kept(c, d), words.p(word))):
                    x[hist[first]] += np.add.reduceat(values, first)
        all_ = np.flatnonzero(sums[0])
        for x in range(0, len(all_), _ROWS):
            h = all_[x:x + _ROWS]
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(words.follow(h)), *[pa.array(s[h]) for s in sums]], ["h", "hc", "kept", "low"])
    return run


def _shares(sent, buckets: int):
    """For the histories that were not sent, what the words not sent that follow them add to their lower-order share."""
    def run(batches):
        words = sent.value
        for b in batches:
            for body in b.column(0):
                e = _Entries(body.as_buffer().to_pybytes())
                on = ~e.hist & e.both & (e.c > 0)
                if on.any():
                    h, low = _added([e.other[on]], [words.share(e.count[on])])
                    bucket = _bucket(h, buckets)
                    order = np.argsort(bucket, kind="stable")
                    h, low, bucket = h[order], low[order], bucket[order]
                    yield _four([(int(bucket[x]), 0, _NO_DOCS, pack(steps(h[x:y]), low[x:y])) for x, y in _slices(bucket)])
    return run


def _score_entries(sent, model):
    """What the entries of words that were not sent add to the texts' sums."""
    def run(batches):
        words, (weight, _, _, d) = sent.value, model.value
        bucket, hs, lows = None, [], []
        for b in batches:
            for i in range(b.num_rows):
                here, body = b.column(0)[i].as_py(), b.column(3)[i].as_buffer().to_pybytes()
                if here != bucket:
                    bucket, hs, lows = here, [], []
                if b.column(1)[i].as_py() == 0:
                    k, x = unpack(body, np.int64, np.float64)
                    hs.append(np.cumsum(k))
                    lows.append(x)
                    continue
                if len(hs) > 1:
                    h, x = _added(hs, lows)
                    hs, lows = [h], [x]
                e = _Entries(body)
                n, seen, share = len(b.column(2)[i].values), e.c > 0, np.log10(words.share(e.count))
                kept = np.where(seen, _kept(np.maximum(e.c, 1), d), 0.0)
                value = np.zeros(len(e.r))
                # as words: what the text does not know, and the pair's bucket does not tell
                on = ~e.hist & ~seen
                value[on] = share[on]
                on = ~e.hist & ~e.both & seen
                value[on] = np.log10(kept[on] / words.follow(e.other[on])) - weight[e.other[on]]
                # as histories
                known = e.hist & ~e.both
                p = np.zeros(len(e.r))
                p[known] = words.p(e.other[known])
                low = np.add.reduceat(np.where(seen, p, 0.0), e.role_first)
                if hs:
                    r = e.r[e.role_first]
                    at = np.minimum(np.searchsorted(hs[0], r), len(hs[0]) - 1)
                    low += np.where(hs[0][at] == r, lows[0][at], 0.0)
                of = np.add.reduceat(kept, e.role_first)
                count = e.count[e.role_first]
                own = np.where(count > 0, np.log10(np.maximum(1e-12, 1 - of / np.maximum(count, 1)) / np.maximum(1e-12, 1 - low)), 0.0)[e.role]
                on = e.hist & ~seen
                value[on] = own[on]
                on = e.hist & seen
                value[on] = np.log10(kept[on] / e.count[on])
                on = known & seen
                value[on] -= np.log10(p[on])
                base = np.where(e.hist, 0.0, words.base(e.count))
                in_ = np.where(e.hist | (e.count == 0), 0.0, 1.0)
                yield pa.RecordBatch.from_arrays([b.column(2)[i].values, pa.array(e.of_texts(in_, n).astype(np.int64)),
                                                  pa.array(e.of_texts(base, n)), pa.array(e.of_texts(value, n))], ["doc", "n_known", "base_score", "score"])
    return run


def _frequent(least: int):
    def run(batches):
        for b in batches:
            for body in b.column(0):
                k, c = unpack(body.as_buffer().to_pybytes(), np.int64, np.int64)
                k, on = np.cumsum(k), c >= least
                yield pa.RecordBatch.from_arrays([pa.array(k[on]), pa.array(c[on])], ["k", "c"])
    return run


_STATS = ["doc", "doc_id", "held_out", "rows", "n_tokens", "n_known", "base_score", "score"]


def _stats_type(kind: str) -> str:
    return f"doc long, doc_id {kind}, held_out boolean, rows long, n_tokens long, n_known long, base_score double, score double"


def _asked(bucket: np.ndarray, key: np.ndarray, text: np.ndarray):
    """Bucket, pair and text of tokens once each, in order, and how often."""
    b, k, t = (int(x.max()).bit_length() for x in (bucket, key, text))
    if b + k + t < 64:  # sorted as one number, in a tenth of the time
        x = np.sort((bucket << (k + t)) | (key << t) | text)
        first = np.flatnonzero(np.append(True, x[1:] != x[:-1]))
        n, x = len(x), x[first]
        bucket, key, text = x >> (k + t), (x >> t) & ((1 << k) - 1), x & ((1 << t) - 1)
    else:
        order = np.lexsort((text, key, bucket))
        bucket, key, text = bucket[order], key[order], text[order]
        first = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (text[1:] != text[:-1])))
        n, bucket, key, text = len(key), bucket[first], key[first], text[first]
    return bucket, key, text, np.diff(np.append(first, n)).astype(np.uint32)


def _score_texts(sent, model, buckets: int):
    """Of each text: its sums by weight and word, and the pairs to ask for."""
    def run(batches):
        words, (weight, often, often_c, d) = sent.value, model.value
        v = words.v
        for b in batches:
            ids = np.asarray(b.column(0))
            for lo, hi, per, h in TS.words(b.column(3)):
                text, hist, word = words.pairs(per, h)
                here = words.all | (word < v)  # of words not sent, their bucket knows the rest
                value = weight[hist] + np.where(here, np.log10(words.p(word)), 0.0)
                base = np.where(here, words.base(words.c[word].astype(np.int64)), 0.0)
                hc = words.follow(hist)
                asked = (word < v) & (hc > 0)
                key = hist * (v + 1) + word
                if len(often):
                    at = np.minimum(np.searchsorted(often, key), len(often) - 1)
                    hit = asked & (often[at] == key)
                    value[hit] = np.log10(_kept(often_c[at[hit]], d) / hc[hit])
                    asked &= ~hit
                n = hi - lo
                of = lambda x: np.bincount(text, x, n)
                doc = ids[lo:hi]
                yield pa.RecordBatch.from_arrays(
                    [pa.array((doc.view(np.uint64) % np.uint64(buckets)).astype(np.int32)), pa.array(np.full(n, 2, np.int32)),
                     lists(pa.array(doc), np.ones(n, np.int64)), pa.nulls(n, pa.binary()),
                     pa.array(doc), b.column(1).slice(lo, n), b.column(2).slice(lo, n), pa.array(np.ones(n, np.int64)),
                     pa.array(per.astype(np.int64) + 1), pa.array(of(word < v).astype(np.int64)), pa.array(of(base)), pa.array(of(value))],
                    ["bucket", "part", "docs", "body", *_STATS])
                key, text = key[asked], text[asked]
                if not len(key):
                    continue
                bucket, key, text, times = _asked(_bucket(key, buckets), key, text)
                rows = []
                for x, y in _slices(bucket):
                    u, r = np.unique(text[x:y], return_inverse=True)
                    rows.append((int(bucket[x]), doc[u], pack(steps(key[x:y]), r.astype(np.uint32), times[x:y])))
                m = len(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int32()), pa.array(np.ones(m, np.int32)),
                     lists(pa.array(np.concatenate([r[1] for r in rows])), np.array([len(r[1]) for r in rows])), pa.array([r[2] for r in rows], pa.binary()),
                     pa.nulls(m, pa.int64()), pa.nulls(m, b.schema.field(1).type), pa.nulls(m, pa.bool_()),
                     *[pa.nulls(m, pa.int64())] * 3, *[pa.nulls(m, pa.float64())] * 2], ["bucket", "part", "docs", "body", *_STATS])
    return run


def _score_pairs(sent, model):
    """What the pairs of a bucket change in the texts' scores; texts' own sums pass through."""
    def run(batches):
        words, (weight, _, _, d) = sent.value, model.value
        v = words.v
        bucket, blocks, keys, change = None, [], np.zeros(0, np.int64), np.zeros(0)
        for b in batches:
            part = np.asarray(b.column(1))
            own = pa.array(part == 2)
            yield pa.RecordBatch.from_arrays([b.column(i).filter(own) for i in range(4, 12)], _STATS)
            for i in np.flatnonzero(part < 2):
                body = b.column(3)[i].as_buffer().to_pybytes()
                here = b.column(0)[i].as_py()
                if here != bucket:
                    bucket, blocks, keys, change = here, [], np.zeros(0, np.int64), np.zeros(0)
                if part[i] == 0:
                    k, c = unpack(body, np.int64, np.int64)
                    k = np.cumsum(k)
                    hist, word = np.divmod(k, v + 1)
                    blocks.append((k, np.log10(_kept(c, d) / words.follow(hist)) - weight[hist] - np.log10(words.p(word))))
                    continue
                if blocks:
                    blocks.sort(key=lambda x: x[0][0])
                    keys, change = (np.concatenate(x) for x in zip(*blocks))
                    blocks = []
                if len(keys):
                    doc = b.column(2)[i].values
                    k, row, times = unpack(body, np.int64, np.uint32, np.uint32)
                    k = np.cumsum(k)
                    at = np.minimum(np.searchsorted(keys, k), len(keys) - 1)
                    more = np.bincount(row, np.where(keys[at] == k, change[at] * times, 0.0), len(doc))
                    n = len(doc)
                    zero = pa.array(np.zeros(n, np.int64))
                    yield pa.RecordBatch.from_arrays([doc, pa.nulls(n, b.schema.field(5).type), pa.nulls(n, pa.bool_()), zero, zero, zero,
                                                      pa.array(np.zeros(n)), pa.array(more)], _STATS)
    return run


def _sent_words(uni: DataFrame, words: int) -> _Words:
    """All words up to ``words`` of them, else the most frequent ones, at most half as many and the end of a text."""
    size, whole = uni.count(), None
    if size > words:
        of = uni.groupBy("c").agg(F.count(F.lit(1)).alias("n")).orderBy("c").toArrow()  # a row a count, fewer than the root of all tokens
        c, n = (np.asarray(x.combine_chunks()) for x in of.columns)
        low, some = c <= CUT + 1, np.zeros(CUT + 2, np.int64)
        some[c[low]] = n[low]
        whole = some, int((c * n).sum()), size
        over = np.cumsum(n[::-1])[::-1]  # words of this count or more
        least = int(c[over <= words // 2].min(initial=c[-1] + 1))
        uni = uni.where((F.col("c") >= least) | (F.col("w") == _END))
    got = uni.toArrow()
    return _Words(np.asarray(got["w"].combine_chunks()), np.asarray(got["c"].combine_chunks()), whole)


def score(docs: DataFrame, held, id_col: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    t = q(text).cast("string")
    src = docs.select(q(id_col).alias("doc_id"), t.alias("text"), F.coalesce(held, F.lit(False)).alias("held_out"))
    kind = docs.schema[id_col].dataType.simpleString()
    train = src.where(~F.col("held_out")).select("text")
    uni = written(train.mapInArrow(_words, "w long, c long").groupBy("w").agg(F.sum("c").alias("c")), "words")
    known = _sent_words(uni, words)
    sent = spark.sparkContext.broadcast(known)
    buckets = max(BUCKETS, -(-known.n // BUCKET_TOKENS))
    ids = src.select(F.xxhash64("doc_id", F.xxhash64("text"), "held_out").alias("doc"), "doc_id", "held_out", "text")
    if known.all:
        pairs = written(dealt(train.mapInArrow(_count_pairs(sent, buckets), "bucket int, body binary"), buckets)
                        .mapInArrow(_add_pairs, "bucket int, body binary, some array<long>"), "pairs").withColumn("part", F.lit(0))
    else:
        pairs = written(dealt(ids.select("doc", "held_out", "text").mapInArrow(_count_all(sent, buckets), _FOUR), buckets, "part")
                        .mapInArrow(_add_all, f"{_FOUR}, some array<long>"), "pairs")
    free_shuffles(spark)
    some = pairs.select(F.posexplode("some").alias("c", "n")).groupBy("c").agg(F.sum("n").alias("n")).collect()  # CUT + 2 rows
    d = good_turing({r["c"]: r["n"] for r in some})
    hist = (pairs.select("body", "part").mapInArrow(_histories(sent, d), "h long, hc long, kept double, low double")
            .groupBy("h").agg(F.max("hc").alias("hc"), F.sum("kept").alias("kept"), F.sum("low").alias("low"))
            .select(F.col("h").cast("int"), F.log10(F.greatest(F.lit(1e-12), 1 - F.col("kept") / F.col("hc"))
                                                    / F.greatest(F.lit(1e-12), 1 - F.col("low"))).alias("weight")).toArrow())  # at most a row a word
    weight = np.zeros(known.v + 2)
    weight[np.asarray(hist["h"].combine_chunks())] = np.asarray(hist["weight"].combine_chunks())
    del hist
    table = pairs.where(F.col("part") == 0)
    most = table.select("body").mapInArrow(_frequent(max(64, known.n // 100_000)), "k long, c long").toArrow()  # at most 100,001 rows
    k, c = (np.asarray(x.combine_chunks()) for x in most.columns)
    order = np.argsort(k)
    model = spark.sparkContext.broadcast((weight, k[order], c[order], d))

    stats = _stats_type(kind)
    texts = ids.mapInArrow(_score_texts(sent, model, buckets), f"bucket int, part int, docs array<long>, body binary, {stats}")
    table = table.select("bucket", F.lit(0).alias("part"), F.lit(None).cast("array<long>").alias("docs"), "body",
                         *[F.lit(None).cast(texts.schema[x].dataType).alias(x) for x in _STATS])
    per = dealt(table.unionByName(texts), buckets, "part").mapInArrow(_score_pairs(sent, model), stats)
    if not known.all:
        rest = pairs.where(F.col("part") == 1).drop("some")
        told = rest.select("body").mapInArrow(_shares(sent, buckets), _FOUR)
        more = dealt(told.unionByName(rest), buckets, "part").mapInArrow(_score_entries(sent, model), "doc long, n_known long, base_score double, score double")
        per = per.unionByName(more.withColumns({"doc_id": F.lit(None).cast(kind), "held_out": F.lit(None).cast("boolean"),
                                                "rows": F.lit(0).cast("long"), "n_tokens": F.lit(0).cast("long")}))
    per = per.groupBy("doc").agg(F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"),
                                 *[F.sum(x).alias(x) for x in _STATS[3:]])
    each = lambda x: (F.col(x) / F.col("rows")).cast("long").alias(x)
    return (per.withColumn("__sl_i", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
            .select("doc_id", "held_out", each("n_tokens"), each("n_known"), F.lit(known.n).cast("long").alias("train_tokens"),
                    (F.col("base_score") / F.col("rows")).alias("base_score"), (F.col("score") / F.col("rows")).alias("score")))
