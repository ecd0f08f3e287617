"""Pair tables in blocks: what a task holds at once does not grow with a bucket."""

import numpy as np
import pyarrow as pa

from starloom.llm import katz, packed


class Sent:
    def __init__(self, value):
        self.value = value


def _rows(keys, counts):
    return pa.RecordBatch.from_arrays([pa.array([4], pa.int32()), pa.array([packed.pack(packed.steps(keys), counts)], pa.binary())], ["bucket", "body"])


def test_buckets_are_added_up_into_small_blocks(monkeypatch):
    monkeypatch.setattr(katz, "BLOCK", 100)
    monkeypatch.setattr(katz, "_HELD", 250)
    rng = np.random.default_rng(1)
    sent = [np.sort(rng.choice(2000, 300, replace=False)).astype(np.int64) for _ in range(7)]
    times = [rng.integers(1, 9, 300) for _ in sent]
    want = np.zeros(2000, np.int64)
    for k, c in zip(sent, times):
        np.add.at(want, k, c)
    keys, counts, some = [], [], np.zeros(katz.CUT + 2, np.int64)
    for b in katz._add_pairs(_rows(k, c) for k, c in zip(sent, times)):
        k, c = packed.unpack(b.column(1)[0].as_py(), np.int64, np.int64)
        assert len(k) <= 100 and b.column(0).to_pylist() == [4]
        keys.append(np.cumsum(k))
        counts.append(c)
        some += b.column(2)[0].as_py()
    keys, counts = np.concatenate(keys), np.concatenate(counts)
    assert (keys == np.flatnonzero(want)).all() and (counts == want[keys]).all()
    assert some.tolist() == [np.count_nonzero(counts == r) for r in range(katz.CUT + 2)]


def _model(words=50):
    known = katz._Words(np.append(np.arange(100, 100 + words), katz._END), np.arange(1, words + 2))
    keys = np.arange(0, words * (known.v + 1), 3, dtype=np.int64)
    keys = keys[keys % (known.v + 1) < known.v]
    return known, keys, np.arange(1, len(keys) + 1, dtype=np.int64) % 7 + 1


def _bodies(keys, counts, size):
    return [packed.pack(packed.steps(keys[x:x + size]), counts[x:x + size]) for x in range(0, len(keys), size)]


def test_histories_of_blocks_are_those_of_the_whole(monkeypatch):
    monkeypatch.setattr(katz, "_ROWS", 16)
    known, keys, counts = _model()
    d = [0.5] * katz.CUT

    def sums(size):
        out = list(katz._histories(Sent(known), d)([pa.RecordBatch.from_arrays([pa.array(_bodies(keys, counts, size), pa.binary())], ["body"])]))
        assert all(b.num_rows <= 16 for b in out)
        return np.array([[x for b in out for x in b.column(i).to_pylist()] for i in range(4)])

    whole = sums(len(keys))
    hist = keys // (known.v + 1)
    kept = np.bincount(hist, np.where(counts <= katz.CUT, 0.5, 1.0) * counts)
    assert np.allclose(whole[2], kept[whole[0].astype(int)], rtol=1e-12) and len(whole[0]) == np.count_nonzero(kept)
    assert np.allclose(sums(40), whole, rtol=1e-12)


def test_blocks_of_a_bucket_score_alike_in_any_order():
    known, keys, counts = _model()
    weight = np.linspace(-2, 0, known.v + 2)
    asked = keys[::5]
    text = pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([1], pa.int32()), pa.array([[71]], pa.list_(pa.int64())),
                                       pa.array([packed.pack(packed.steps(asked), np.zeros(len(asked), np.uint32), np.ones(len(asked), np.uint32))], pa.binary()),
                                       *[pa.nulls(1, t) for t in (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())]],
                                      ["bucket", "part", "docs", "body", *katz._STATS])

    def change(bodies):
        n = len(bodies)
        table = pa.RecordBatch.from_arrays([pa.array([0] * n, pa.int32()), pa.array([0] * n, pa.int32()), pa.nulls(n, pa.list_(pa.int64())), pa.array(bodies, pa.binary()),
                                            *[pa.nulls(n, text.schema.field(i).type) for i in range(4, 12)]], text.schema.names)
        out = katz._score_pairs(Sent(known), Sent((weight, None, None, [0.5] * katz.CUT)))([table, text])
        return sum(x for b in out for x in b.column(7).to_pylist())

    whole = change(_bodies(keys, counts, len(keys)))
    assert whole != 0
    assert change(_bodies(keys, counts, 37)[::-1]) == whole
