"""Candidate pairs between different components of a group, block by block.

A group's members are dealt into blocks, and blocks are held against each other
in tasks of their own (rows ``t, a, z, block, node, comp, n, sketch``, and
``short`` where signatures are counted; a part is one ``t, a, z``).  A pair
passes if the sizes and the parity sketches of its sets allow a link: sketches
differ in no more bits than the sets in elements.  Pairs are never rows, only
those that pass are.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Members a block holds about, and of a part that is compared together with others.
BLOCK, SMALL = 512, 64


def folded(x: np.ndarray, size: int) -> np.ndarray:
    """Sketches (along the last axis) folded to ``size`` bytes."""
    while x.shape[-1] > size:
        half = x.shape[-1] // 2
        x = x[..., :half] ^ x[..., half:]
    return x


def apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Elements in which two sets differ at least, from their sketches."""
    size = min(x.shape[-1], y.shape[-1])
    return np.bitwise_count(folded(x, size) ^ folded(y, size)).sum(axis=-1, dtype=np.int64)


def may_differ(a, b, num: int, den: int):
    """Elements in which linked sets of sizes ``a`` and ``b`` differ at most."""
    return a + b - 2 * -((-num * (a + b)) // (num + den))


def across(block: np.ndarray, node: np.ndarray, comp: np.ndarray, n: np.ndarray, sketch: list[np.ndarray],
           num: int, den: int, forest: bool = False,
           agree: Callable[[np.ndarray, np.ndarray, int], np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one part that may link: of two blocks those between them, of
    one those inside; in different components.  ``forest``: no more than join
    the components that such pairs could join.  ``agree(order, j, i)`` says
    which of the members ``j`` pass a further test against ``i``, all of them
    places in ``order``."""
    order = np.argsort(n, kind="stable")
    block, node, n = block[order], node[order], n[order]
    label = np.unique(comp[order], return_inverse=True)[1]
    two = block.min() != block.max()
    upto = np.searchsorted(n * num, n * den, "right")  # larger ones are skipped
    sizes = np.array([len(sketch[i]) for i in order])
    stacked = {size: np.stack([folded(sketch[i], size) if len(sketch[i]) >= size else np.zeros(size, np.uint8) for i in order])
               for size in np.unique(sizes)}
    us, vs = [], []
    for i in range(len(n) - 1):
        j = np.arange(i + 1, upto[i])
        j = j[(label[j] != label[i]) & (node[j] != node[i])]
        if two:
            j = j[block[j] != block[i]]
        if len(j) and agree is not None:
            j = j[agree(order, j, i)]
        if len(j):  # larger sets have sketches as long, or longer
            at = stacked[sizes[i]]
            j = j[apart(at[j], at[i]) <= may_differ(n[i], n[j], num, den)]
        if len(j):
            if forest:
                j = j[np.unique(label[j], return_index=True)[1]]
                label[np.isin(label, label[j])] = label[i]
            us.append(np.minimum(node[i], node[j]))
            vs.append(np.maximum(node[i], node[j]))
    return (np.concatenate(us), np.concatenate(vs)) if us else (np.zeros(0, np.int64),) * 2


def across_small(part: np.ndarray, block: np.ndarray, node: np.ndarray, comp: np.ndarray, n: np.ndarray, sketch: list[bytes],
                 num: int, den: int, forest: bool = False,
                 agree: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """``across`` over many small parts at once (``part``: their numbers, in
    order): every row with the next one of its part, the second next, and so
    on.  ``forest``: of each row the first such pair only."""
    sizes = np.array([len(x) for x in sketch])
    at_size = {}
    for size in np.unique(sizes):
        m = np.zeros((len(n), size), np.uint8)
        for longer in np.unique(sizes[sizes >= size]):
            rows = np.flatnonzero(sizes == longer)
            m[rows] = folded(np.frombuffer(b"".join(sketch[i] for i in rows), np.uint8).reshape(-1, longer), size)
        at_size[size] = m
    order, free = np.arange(len(n)), np.ones(len(n), bool)
    most = int(np.bincount(part).max()) if len(part) else 0
    us, vs = [], []
    for step in range(1, most):
        i = np.flatnonzero((part[step:] == part[:-step]) & free[:-step])
        j = i + step
        ok = (comp[i] != comp[j]) & (node[i] != node[j]) & (np.minimum(n[i], n[j]) * den >= np.maximum(n[i], n[j]) * num)
        i, j = i[ok], j[ok]
        if len(i) and agree is not None:
            ok = agree(order, j, i)
            i, j = i[ok], j[ok]
        if len(i):
            bits, least = np.empty(len(i), np.int64), np.minimum(sizes[i], sizes[j])
            for size, m in at_size.items():
                x = np.flatnonzero(least == size)
                bits[x] = np.bitwise_count(m[i[x]] ^ m[j[x]]).sum(axis=1, dtype=np.int64)
            ok = bits <= may_differ(n[i], n[j], num, den)
            i, j = i[ok], j[ok]
            us.append(np.minimum(node[i], node[j]))
            vs.append(np.maximum(node[i], node[j]))
            if forest:
                free[i] = False
    return (np.concatenate(us), np.concatenate(vs)) if us else (np.zeros(0, np.int64),) * 2


def dealt(members: DataFrame, size: str, block: int = BLOCK) -> DataFrame:
    """``members`` (t, node, ..., and ``size``, the group's) in the parts of
    their group, one part after another in a task."""
    blocks = F.ceil(F.col(size) / block).cast("int")
    rest = [c for c in members.columns if c not in ("t", size)]
    return (members.withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
            .select("t", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("z"), "block", *rest)
            .repartition("t", "a", "z").sortWithinPartitions("t", "a", "z"))


def pairs_of(num: int, den: int, forest: bool, counted: Callable | None = None):
    """For ``mapInArrow`` over ``dealt`` rows: a part at a time, whatever the
    batches.  ``counted`` makes the ``agree`` of a part from its ``short`` column."""
    def run(batches):
        held: pa.Table | None = None

        def parts(table, last):
            keys = [np.asarray(table["t"]), np.asarray(table["a"]), np.asarray(table["z"])]
            new = np.ones(table.num_rows, bool)
            new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
            at = np.append(np.flatnonzero(new), table.num_rows)
            ends = len(at) - 1 if last else len(at) - 2
            done = table.slice(0, at[max(ends, 0)])
            cols = [np.asarray(done[c]) for c in ("block", "node", "comp", "n")]
            sketch, whole = done["sketch"].to_pylist(), np.asarray(done["a"]) == np.asarray(done["z"])
            at = at[:max(ends, 0) + 1]
            length = np.diff(at)
            # small parts, each of one block, are compared together, the others one by one
            small = (length > 1) & (length <= SMALL) & (whole[at[:-1]] if len(whole) else np.zeros(0, bool))
            us, vs = [], []
            rows = np.flatnonzero(np.repeat(small, length))
            if len(rows):
                agree = counted(done["short"].take(pa.array(rows))) if counted else None
                u, v = across_small(np.repeat(np.arange(len(length)), length)[rows], *(c[rows] for c in cols),
                                    [sketch[i] for i in rows], num, den, forest, agree)
                us.append(u)
                vs.append(v)
            for i in np.flatnonzero((length > 1) & ~small):
                a, z = at[i], at[i + 1]
                agree = counted(done["short"].slice(a, z - a)) if counted else None
                u, v = across(*(c[a:z] for c in cols), [np.frombuffer(x, np.uint8) for x in sketch[a:z]], num, den, forest, agree)
                us.append(u)
                vs.append(v)
            u, v = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (us, vs))
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"]), table.slice(at[-1])
        for b in batches:
            if b.num_rows:
                t = pa.Table.from_batches([b])
                held = (pa.concat_tables([held, t]) if held is not None else t).combine_chunks()
                out, held = parts(held, False)
                yield out
        if held is not None and held.num_rows:
            yield parts(held.combine_chunks(), True)[0]
    return run
