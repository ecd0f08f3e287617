"""What the network of the secret scan reads around a run, and the texts' windows that meet benchmark items."""

from __future__ import annotations

import random

import numpy as np

from starloom.llm import decontaminate as D
from starloom.llm import secret_scan as S


def _model(rng, words):
    some = lambda n: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"), n))
    found = [(some(20), ("log in with = '", "' and go")) for _ in range(60)]
    others = [(w, ("the very " + w[:5] + " ", " of it all")) for w in words]
    return S._surrounded(S._fitted([r for r, _ in found], [r for r, _ in others]), found, others)


def _words(rng, n):
    parts = ["con", "ver", "sa", "tion", "al", "ment", "pre", "sent", "ing", "de", "pend", "er", "com", "mu", "ni", "ca", "te", "ly"]
    return sorted({"".join(rng.choice(parts, 4)) for _ in range(n)})


def test_secret_score_depends_on_the_surroundings():
    rng = np.random.default_rng(4)
    model = _model(rng, _words(rng, 400))
    signed, plain = S._near(model, [("log in with = '", "' and go"), ("the very comal ", " of it all")])
    assert signed > plain and model["layer"][1] >= 0
    assert model["recall"] >= S.RECALL


def test_secret_surroundings_have_no_keyword():
    text = "my API_Key = 'abcdefgh12345678' here"
    a = text.index("abcdefgh")
    left, right = S._around(text, a, a + 16)
    assert (left, right) == ("my  = '", "' here")
    assert S._bare(left, right) == ("my ", " here")
    assert S._around("xabcdefgh", 1, 9) == ("x", "")


def test_secret_runs_are_flagged_as_if_all_surroundings_were_read():
    rng = np.random.default_rng(5)
    words = _words(rng, 500)
    model = _model(rng, words)
    mixed = list("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
    texts = [" ".join([*rng.choice(words, 30), "".join(rng.choice(mixed, 18)), "x = '" + str(rng.choice(words)) + "'"]) for _ in range(60)]
    cand = [S._others(t, S.base(t)) for t in texts]
    a, w, b = model["layer"]
    want = []
    for t, c in zip(texts, cand):
        p = S._sigmoid(a * S._logits(model, [t[s:e] for s, e in c]) + w * S._near(model, [S._around(t, s, e) for s, e in c]) + b)
        want.append([x for x, o in zip(c, p) if o >= model["threshold"]])
    assert S._flagged(model, texts, cand, {}) == want
    assert sum(map(len, want)) >= 50


def test_benchmark_windows_by_a_plain_loop(monkeypatch):
    """Hashes of windows choose the places, the keys decide; chunks and cleared words change nothing."""
    rng = random.Random(3)
    vocabulary = ["a", "b", "The", "5", "7", "$5", "km", "x=3", "is", "5kg", "Rome", "-", "of", "...", "q\x1fz"]
    for at_once, known in ((1, 3), (50, 100), (1 << 18, 100_000)):
        monkeypatch.setattr(D, "_AT_ONCE", at_once)
        monkeypatch.setattr(D, "_KNOWN", known)
        for _ in range(8):
            table = {}
            for i in range(8):
                w = D.template(" ".join(rng.choices(vocabulary, k=rng.randint(0, 16))))
                size = min(D.WINDOW, len(w))
                for k, p in D._windows(w, size) if size else ():
                    table.setdefault(size, {}).setdefault(k, []).append((i, [v for _, v in w[p:p + size]]))
            texts = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 60)))) for i in range(40)] + [(40, None), (41, "")]
            want = {}
            for i, t in texts:
                w = D.template(t)
                for size, keys in table.items():
                    for p in range(len(w) - size + 1):
                        part = w[p:p + size]
                        hits = [x for x, slots in keys.get("\x1f".join(k for k, _ in part), ()) if D._consistent(slots, [v for _, v in part])]
                        for x in hits + [x for x, _ in keys.get(D._exact(part), ())]:
                            want.setdefault(i, {}).setdefault(x, 0)
                            want[i][x] += 1
            assert dict(D._Known(table).met(D._Words(), texts)) == want
