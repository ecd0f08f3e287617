"""Parts compared together and one by one, whatever the batches."""

import numpy as np
import pyarrow as pa
import pytest

from starloom.llm import blocks
from starloom.llm import minhash_join as MJ


def members(seed=3):
    rng = np.random.default_rng(seed)
    base = rng.integers(1, 2 ** 63, 900, dtype=np.uint64)
    rows = []
    for t, size in enumerate([1, 2, 3, 64, 65, 5, 130, 2, 1, 40]):
        for z in ((0, 0),) if size != 130 else ((0, 0), (0, 1), (1, 1)):
            for k in range(size if size != 130 else 65 * (1 + (z[0] != z[1]))):
                m = int(rng.integers(90, 400 if t % 2 else 110))
                s = np.sort(base[k % 6:k % 6 + m])
                rows.append((t, *z, (k % 2 if z[0] != z[1] else z[0]), int(rng.integers(1, 10 ** 9)), int(rng.integers(0, 6)), m,
                             MJ.sketches(np.array([m]), s)[0].tobytes()))
    return rows


def expected(rows):
    out = set()
    for i, x in enumerate(rows):
        for y in rows[:i]:
            if x[:3] == y[:3] and x[5] != y[5] and (x[1] == x[2] or x[3] != y[3]) and min(x[6], y[6]) * 100 >= max(x[6], y[6]) * 85:
                a, b = (np.frombuffer(r[7], np.uint8) for r in (x, y))
                if blocks.apart(a, b) <= blocks.may_differ(x[6], y[6], 85, 100):
                    out.add((min(x[4], y[4]), max(x[4], y[4])))
    return out


@pytest.mark.parametrize("batch", [7, 100, 10_000])
def test_pairs_of_all_parts(batch):
    rows = members()
    table = pa.table({n: pa.array(c) for n, c in zip(("t", "a", "z", "block", "node", "comp", "n", "sketch"), zip(*rows))})
    run = lambda forest: {p for b in blocks.pairs_of(85, 100, forest)(iter(table.to_batches(batch)))
                          for p in zip(b.column(0).to_pylist(), b.column(1).to_pylist())}
    want = expected(rows)
    assert run(False) == want and len(want) > 100
    forest = run(True)
    assert forest <= want and len(forest) < len(rows)


def test_no_rows():
    empty = pa.table({n: pa.array([], pa.int64()) for n in ("t", "a", "z", "block", "node", "comp", "n")} | {"sketch": pa.array([], pa.binary())})
    assert sum(b.num_rows for b in blocks.pairs_of(85, 100, False)(iter(empty.to_batches()))) == 0
