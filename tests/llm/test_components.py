"""Components of link tables, in one task's share and in many, against a plain search."""

import re

import numpy as np
import pytest

from starloom.llm import components as C


def _plain(links):
    near = {}
    for u, v in links:
        if u != v:
            near.setdefault(u, set()).add(v)
            near.setdefault(v, set()).add(u)
    comp = {}
    for start in sorted(near):
        todo = [start] if start not in comp else []
        while todo:
            x = todo.pop()
            if x not in comp:
                comp[x] = start
                todo.extend(near[x])
    return comp


@pytest.fixture(scope="module")
def made():
    rng = np.random.default_rng(4)
    ids = rng.integers(-2 ** 63, 2 ** 63 - 1, 700)
    path = list(zip(ids[:200], ids[1:200]))
    hub = [(ids[200], x) for x in ids[201:400]]
    rest = list(zip(rng.choice(ids[400:], 150), rng.choice(ids[400:], 150)))
    every = path + hub + rest + hub[:20] + [(v, u) for u, v in path[:30]] + [(ids[699], ids[699])]
    return [(int(u), int(v)) for u, v in rng.permutation(np.array(every, np.int64))]


@pytest.mark.parametrize("share", [C.LINKS, 40])
def test_components_against_a_plain_search(spark, made, monkeypatch, share):
    monkeypatch.setattr(C, "LINKS", share)
    links = spark.createDataFrame(made, "u long, v long").repartition(7)
    got = C.components(links).collect()
    assert len(got) == len({r.node for r in got})
    assert {r.node: r.comp for r in got} == _plain(made)
    assert C.components(links.where("u = v")).count() == 0


def test_extended_components(spark, made):
    cut = len(made) // 2
    frame = lambda rows: spark.createDataFrame(rows, "u long, v long")
    got = C.extended(C.components(frame(made[:cut])), frame(made[cut:])).collect()
    assert len(got) == len({r.node for r in got})
    # a self link names its node here
    assert {r.node: r.comp for r in got} == {u: u for u, v in made[cut:] if u == v} | _plain(made)


def test_a_task_holds_a_bounded_number_of_links():
    import pyarrow as pa
    batch = lambda a, b: pa.RecordBatch.from_arrays([pa.array(range(a, b)), pa.array(range(a + 1, b + 1))], ["u", "v"])
    out = [b.to_pylist() for b in C._forests(100)(batch(a, a + 60) for a in range(0, 600, 60))]
    assert [len(x) for x in out] == [120] * 5
    assert all(r["v"] == x[0]["v"] and r["v"] < r["u"] for x in out for r in x)


def test_a_small_link_table_takes_few_exchanges(spark, made, monkeypatch):
    """Every exchange and broadcast costs the driver a thread; rounds of stars have twenty."""
    plans = []
    keep = C.written

    def written(df, *a):
        out = keep(df, *a)
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return out
    monkeypatch.setattr(C, "written", written)
    C.components(spark.createDataFrame(made, "u long, v long")).count()
    assert len(plans) <= 3
    assert sum(len(re.findall(r"Exchange ", p)) for p in plans) <= 2
