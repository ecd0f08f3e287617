"""Words beyond the bound of the broadcast: entries by bucket instead of joins, same scores."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starloom.llm import katz


@pytest.fixture(scope="module")
def texts(spark):
    rng = np.random.default_rng(11)
    words = np.array([f"w{i}" for i in range(500)])
    some = lambda n: " ".join(words[np.minimum(rng.zipf(1.3, n) - 1, 499)])
    rows = [(i, some(int(rng.integers(0, 90)))) for i in range(60)]
    rows += [(7, rows[7][1]), (None, rows[9][1]), (61, None), (62, ""), (63, "new1 new2 w0 new1 new2 w499"), (64, "new1 w3 new2"), (70, some(4000))]
    return spark.createDataFrame(rows, "doc_id long, text string").cache()


@pytest.fixture(scope="module")
def all_sent(texts):
    return _rows(katz.score(texts, _held()))


def _held():
    return F.coalesce((F.col("doc_id") % 5 == 2) | F.col("doc_id").isin(63, 64), F.lit(False))


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (str(r[0]), r[2:5], r[5]))


@pytest.mark.parametrize("words", [0, 9, 60, 400])
def test_words_that_are_not_sent_score_alike(texts, all_sent, words):
    got = _rows(katz.score(texts, _held(), words=words))
    assert [r[:5] for r in got] == [r[:5] for r in all_sent]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in all_sent], rtol=1e-9)


def test_no_token_is_joined(texts):
    plan = katz.score(texts, _held(), words=60)._jdf.queryExecution().toString()
    assert "Join" not in plan


def test_most_frequent_words_are_sent(spark):
    uni = spark.createDataFrame([(katz._END, 1), (10, 9), (11, 9), (12, 4), (13, 4), (14, 4), (15, 1)], "w long, c long")
    known = katz._sent_words(uni, 6)
    assert known.w.tolist() == [katz._END, 10, 11] and not known.all and (known.n, known.size) == (32, 7)
    whole = katz._sent_words(uni, 7)
    assert whole.all and whole.v == 7 and (known.d, known.none) == (whole.d, whole.none)


def test_words_are_found_by_their_first_bits():
    rng = np.random.default_rng(2)
    w = np.unique(np.concatenate([rng.integers(-2 ** 63, 2 ** 63, 3000), np.arange(5), [-2 ** 63, 2 ** 63 - 1], np.arange(40) + 2 ** 50]))
    known = katz._Words(rng.permutation(w), np.ones(len(w), np.int64))
    ask = np.concatenate([w, rng.integers(-2 ** 63, 2 ** 63, 500), np.arange(5, 60), [2 ** 50 + 40]])
    assert known.ids(ask).tolist() == [{x: i for i, x in enumerate(w.tolist())}.get(x, len(w)) for x in ask.tolist()]


def test_asked_pairs_are_in_order_however_long():
    rng = np.random.default_rng(3)
    for top in (1 << 30, 1 << 59):
        bucket, key, text = rng.integers(0, 5, 400), rng.choice(rng.integers(0, top, 30), 400), rng.integers(0, 9, 400)
        want = sorted(Counter(zip(bucket.tolist(), key.tolist(), text.tolist())).items())
        assert [((b, k, t), n) for b, k, t, n in zip(*(x.tolist() for x in katz._asked(bucket, key, text)))] == want


def test_blocks_have_all_entries_of_a_word(monkeypatch):
    monkeypatch.setattr(katz, "BLOCK", 50)
    rng = np.random.default_rng(4)
    rows, train, texts = [], Counter(), Counter()
    for n in range(6):
        r, other = np.sort(rng.integers(100, 140, 80)), rng.integers(0, 6, 80)
        bits, row, times = rng.choice([0, katz._BOTH, katz._HIST, katz._HIST | katz._BOTH], 80) | rng.choice([0, katz._HELD_OUT], 80), rng.integers(0, 3, 80), rng.integers(1, 4, 80)
        rows.append((4, 1, np.arange(3) + 10 * n, katz._packed_entries(r, other, row, times, bits)))
        for a, o, b, t, c in zip(*(x.tolist() for x in (r, other, bits, row, times))):
            train[a, o, b & 3] += 0 if b & katz._HELD_OUT else c
            texts[a, o, b, t + 10 * n] += c
    blocks = [b for b in katz._add_all([katz._four(rows)]) if b.num_rows]
    words, some, got = [], np.zeros(katz.CUT + 2, np.int64), Counter()
    for b in blocks:
        docs, body = np.array(b.column(2)[0].values), b.column(3)[0].as_py()
        r, other, row, times, bits = katz._unpacked_entries(body)
        words += np.unique(r).tolist()
        some += b.column(4)[0].as_py()
        for a, o, t, c, k in zip(*(x.tolist() for x in (r, other, docs[row], times, bits))):
            got[a, o, k, t] += c
        e = katz._Entries(body)
        for a, o, c, both, hist in zip(*(x.tolist() for x in (e.r, e.other, e.c, e.both, e.hist))):
            assert c == train[a, o, both * katz._BOTH + hist * katz._HIST]
    assert len(blocks) > 3 and words == sorted(set(words)) and got == texts
    counts = Counter(c for (_, _, k), c in train.items() if c and k != katz._BOTH)
    assert some.tolist() == [counts[i] for i in range(katz.CUT + 2)]
    assert isinstance(blocks[0], pa.RecordBatch)
