"""The pipeline's stages on rows with null and repeated ids, against brute force."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from starloom.llm import decontaminate, entropy_mix, sharding, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(400)]
    text = lambda n: " ".join(rng.choice(words, n))
    base, other = text(60), text(60)
    near = base.replace(base.split()[30], "changed", 1)
    made = [(None, text(30)), (None, text(30)), (None, text(30)), (None, base), (None, near), (None, other), (4, base), (4, other), (4, text(40)),
            (3, near), (9, text(25)), (9, text(25)), (9, text(25)), (5, "same row twice"), (5, "same row twice"), (None, "no id twice"),
            (None, "no id twice"), (None, None), (None, ""), (6, None), (6, None), (7, " \t")]
    return [(i, t, "en", f"s{n % 3}", n) for n, (i, t) in enumerate(made)]


def _components(texts):
    sets = []
    for t in texts:
        w = WORD.findall((t or "").lower())
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    comp = list(range(len(sets)))
    for _ in sets:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= 80 * len(a | b):
                    comp[i] = comp[j] = min(comp[i], comp[j])
    return comp


def test_near_duplicates_keeps_one_row_of_each_component(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    out = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert out.columns == docs.columns
    comp = _components([r[1] for r in rows])
    got = Counter((r.doc_id, r.text) for r in out.collect())
    by = {}
    for c, r in zip(comp, rows):
        by.setdefault(c, []).append(r[:2])
    assert sum(got.values()) == len(by)
    assert any(len(m) > 1 for m in by.values())
    for members in by.values():
        ids = [i for i, _ in members if i is not None]
        allowed = {m for m in members if m[0] == (min(ids) if ids else None)}
        assert any(got[m] for m in allowed)
        if WORD.findall(members[0][1] or ""):
            assert sum(got[m] for m in set(members)) == 1


def test_toxicity_stage_keeps_what_scores_low(spark, rows, monkeypatch):
    docs = spark.createDataFrame(rows + [(50, "vile vile", "en", "s0", 0), (None, "vile thing", "en", "s1", 0)], SCHEMA)
    monkeypatch.setattr(corpus_pipeline, "table", lambda *a: spark.createDataFrame(
        [(n, int(n % 2)) for n in range(1000, 1120)], "doc_id long, toxic int"))
    known = [(n, ("vile words here " if n % 2 else "kind words here ") + f"w{n}", "en", "s0", 0) for n in range(1000, 1120)]
    docs = docs.unionByName(spark.createDataFrame(known, SCHEMA))
    model = toxicity.trained(docs, corpus_pipeline.table())
    want = [(r.doc_id, r.text) for r in toxicity.score(docs, model).collect() if r.score < 0.7]
    out = corpus_pipeline.drop_toxic(spark, docs, "")
    assert out.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == sorted(want, key=repr)
    assert not any("vile" in (t or "") for _, t in want) and (9, rows[10][1]) in want


def test_decontamination_stage_drops_matching_rows_only(spark, rows, monkeypatch):
    docs = spark.createDataFrame(rows, SCHEMA)
    item = " ".join(rows[1][1].split()[5:20])
    monkeypatch.setattr(corpus_pipeline, "table", lambda *a: spark.createDataFrame([(1, item)], "item_id long, text string"))
    out = corpus_pipeline.drop_contaminated(spark, docs, "")
    want = [r[:2] for r in rows if r[1] != rows[1][1]]
    assert out.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == sorted(want, key=repr)


def test_mixing_and_sharding_take_every_copy(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    mixed = corpus_pipeline.mix_sources(spark, docs, "")
    want = entropy_mix.mix(docs).agg(F.sum("copies")).first()[0]
    assert mixed.columns == docs.columns and mixed.count() == want
    out = corpus_pipeline.shard(spark, mixed, "")
    assert out.count() == want and out.where("shard is null").count() == 0
