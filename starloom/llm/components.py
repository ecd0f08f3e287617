"""Connected components of a link table by alternating large-star and
small-star steps.  Links and labels stay distributed; each step is an
aggregate (combined map-side, so a hub costs one row a task) and a join that
adaptive execution may split, and is written to the shared folder.

Every task also replaces the links it holds, a bounded number at a time, by a
forest that joins the same nodes.  A link table of no more than one task's
share needs nothing else.  That keeps the driver small: a step is some twenty
exchanges and broadcasts, and each costs it a thread, whatever the rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import written


#: Links a task holds at once, and the fewest tasks of a table of more.
LINKS, TASKS = 200_000, 8


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, least node it reaches) that join what the links ``u``, ``v`` join."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[:len(u)], at[len(u):]
    root = np.arange(len(nodes))
    while True:  # ends: each turn hooks the larger of two roots at least
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            break
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (up := root[root]).tobytes() != root.tobytes():
            root = up
    low = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[low], nodes[root[low]]


def _forests(most: int, ends: tuple[str, str] = ("u", "v"), roots: bool = False):
    """For ``mapInArrow``: the links of a task as forests of ``most`` links or a
    batch more.  ``roots``: with the least nodes as their own."""
    def run(batches):
        us, vs, held = [], [], 0

        def out():
            u, v = forest(np.concatenate(us), np.concatenate(vs))
            top = np.unique(v) if roots else v[:0]
            return pa.RecordBatch.from_arrays([pa.array(np.append(u, top)), pa.array(np.append(v, top))], list(ends))
        for b in batches:
            us.append(np.asarray(b.column(0)))
            vs.append(np.asarray(b.column(1)))
            held += b.num_rows
            if held > most:
                yield out()
                us, vs, held = [], [], 0
        if held:
            yield out()
    return run


def _star(edges: DataFrame, large: bool, tasks: int) -> DataFrame:
    """Links every neighbour of a node above it (large) or not above it (small)
    to the least node among the neighbours and itself."""
    if large:
        near = edges.select(F.col("u"), F.col("v")).unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:  # links point from the greater to the lesser end
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")).coalesce(tasks)
    joined = near.join(least, "u").coalesce(tasks)
    if large:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return out.where(F.col("u") != F.col("v")).distinct().coalesce(tasks)


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``links`` (u, v long) -> (node, comp): the least node each node reaches.
    Only nodes with a link appear."""
    joined = lambda e: written(e.mapInArrow(_forests(LINKS), "u long, v long"), "links")
    mark = lambda e: tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    edges, last = joined(links.where(F.col("u") != F.col("v")).select("u", "v")), None
    for _ in range(max_rounds):
        now = mark(edges)
        if now[0] <= LINKS:
            return written(edges.coalesce(1).mapInArrow(_forests(LINKS, ("node", "comp"), True), "node long, comp long"), "components")
        if now == last:
            break
        last, tasks = now, max(TASKS, -(-now[0] // LINKS))
        edges = joined(_star(_star(edges, True, tasks), False, tasks))
    else:
        raise RuntimeError("components did not settle")
    return written(edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct()), "components")


def extended(comp: DataFrame, links: DataFrame) -> DataFrame:
    """The components after more ``links`` between nodes of ``comp`` (node,
    comp) and others: only the graph of the components they touch is worked on."""
    of = lambda end: comp.select(F.col("node").alias(end), F.col("comp").alias(f"c{end}"))
    named = written(links.join(of("u"), "u", "left").join(of("v"), "v", "left").select("u", "v", "cu", "cv"), "links")
    merged = components(named.select(F.coalesce("cu", "u").alias("u"), F.coalesce("cv", "v").alias("v")))
    new = lambda end: named.where(F.col(f"c{end}").isNull()).select(F.col(end).alias("node"), F.col(end).alias("comp"))
    fresh = new("u").unionByName(new("v")).distinct()
    to = merged.select(F.col("node").alias("comp"), F.col("comp").alias("to"))
    return written(comp.unionByName(fresh).join(to, "comp", "left").select("node", F.coalesce("to", "comp").alias("comp")), "components")
