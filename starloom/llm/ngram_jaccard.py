"""N-gram Jaccard join by PartEnum signatures.

A document is the set of its distinct k-word shingles.  Sets that link
(``intersection * 100 >= 80 * union``) differ in size by a factor of at most
1.25 and in at most ``(1-t)/(1+t)`` of the sum of their sizes.  So:

* sizes fall into bands, each 1.25 times as wide as what precedes it; a set
  takes part in the instance of its own band and in the next, and any two sets
  that link share an instance;
* an instance with largest difference ``k`` cuts the hash domain into
  ``k + m`` partitions.  Two sets that link differ in at most ``k`` of them, so
  at least ``m`` partitions hold the same elements in both.  A signature is the
  hash of what a set has in one partition;
* a set with fewer than ``m`` empty partitions needs no signature for those.
  A set with more is cut again with other hashes (both sets of a pair must have
  had too many for it to be missed), and after the last such cut also signs
  that it has empty ones.

Signature groups give candidates, and the sets themselves decide.  Work is kept
away from the square of a group's size:

1. equal sets are one node from the start;
2. every member of a group is held against the group's least node, which
   settles groups of near copies with one pair a member; the components found
   so far are then taken, and members outside are held against the least of
   themselves;
3. what remains are groups whose members are in different components.  Among
   groups where that would cost more than ``HOT`` pairs, every node leaves its
   largest ones, as long as its left and empty partitions stay below ``m``: the
   rarest partition that two linked sets share is then kept by both.  What is
   left is dealt into blocks, whose members are held against those of other
   components by sizes and sketches in memory: first one pair is sent on for
   every two components that some pair could join, and once those are decided
   all pairs left that may link.

A pair is tested by its sizes, then by parity sketches (one bit per hash value
modulo a power of two, whether an odd number of elements has it): sketches
differ in no more bits than the sets in elements, so no link is lost, and only
the pairs left need the sets themselves.

The components are therefore exactly those of all links, but for clashes of
64-bit hashes.

Defined results: null or wordless text is the empty set, links with nothing
and is its own component; 1 to k-1 words form one shingle; repeated rows and
repeated or null doc_ids are rows like others (a component's id is the least
doc_id in it, null if it has none); very long texts are read whole; an empty
table gives an empty result; other columns of the input play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from starloom.llm import blocks
from starloom.llm import textscan as TS
from starloom.llm.common import WORD, free_shuffles, q, written
from starloom.llm.components import components, extended

K = 5
NUM, DEN = 80, 100
#: Pairs a signature group may cost before nodes that can spare it drop it.
HOT = 2048
#: Bytes of the sketches that travel with the members of open groups.
SKETCH = 128
_LEVELS = 3
_U = np.uint64
_BANDS: dict = {}
_SEED = [_U(0xA0761D6478BD642F), _U(0xE7037ED1A0B428DB), _U(0x8EBC6AF09C88C6E3), _U(0x589965CC75374CC3)]
#: Node keys a task remembers, so that copies sign once a task.
_SEEN = 200_000


def _too_many_empty(size: int, n: int, m: int) -> float:
    """Odds that ``size`` hashes leave ``m`` or more of ``n`` partitions empty."""
    odds = np.zeros(n + 1)  # by the number of filled partitions
    odds[0] = 1.0
    for _ in range(size):
        filled = np.arange(n + 1) / n
        odds = odds * filled + np.concatenate([[0.0], (odds * (1 - filled))[:-1]])
    return float(odds[:max(0, n - m + 1)].sum())


def bands(num: int = NUM, den: int = DEN, most: int = 1 << 31) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Least size of every band; differences ``k`` and partitions ``n`` of every instance."""
    if (num, den, most) in _BANDS:
        return _BANDS[num, den, most]
    low, k, n = [1], [], []
    while low[-1] < most:
        low.append(low[-1] * den // num + 1)
    for j in range(len(low) - 1):
        top = low[j + 1] - 1
        diff = 2 * top * (den - num) // (den + num)
        spare = 1
        if diff:  # a set of the least size should seldom have as many empty partitions
            small = low[max(j - 1, 0)]
            if small < 60:
                odds = {m: _too_many_empty(int(small), diff + m, m) for m in range(1, 2 * diff + 6)}
                spare = next((m for m in odds if odds[m] <= 0.003), min(odds, key=odds.get))
            else:
                for _ in range(30):
                    empty = (diff + spare) * np.exp(-small / (diff + spare))
                    spare = int(np.ceil(1 + empty + 3 * np.sqrt(empty) + 0.02 * diff))
        k.append(diff)
        n.append(diff + spare)
    _BANDS[num, den, most] = np.array(low, np.int64), np.array(k, np.int64), np.array(n, np.int64)
    return _BANDS[num, den, most]


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts) if len(starts) else np.zeros(0, np.uint64)


def node_keys(per: np.ndarray, s: np.ndarray) -> np.ndarray:
    """One key per set: equal for equal sets, 0 for the empty one."""
    out = np.zeros(len(per), np.uint64)
    has = per > 0
    first = (np.cumsum(per) - per)[has]
    out[has] = TS.mix(_sums(TS.mix(s ^ _SEED[0]), first) + per[has].astype(np.uint64) * _SEED[1]) | _U(1)
    return out


def signatures(per: np.ndarray, s: np.ndarray, num: int = NUM, den: int = DEN):
    """Signatures of sets (sorted values ``s``, ``per`` values each).

    Returns the set's index and value of each signature (its lowest bit is the
    instance's number modulo 2), the band of each set, and for its two instances
    how many signatures it can spare (-1: none; it was cut again).
    """
    low, k, n = bands(num, den)
    has = np.flatnonzero(per > 0)
    band = np.searchsorted(low, per, "right") - 1
    spare = np.full((2, len(per)), -1, np.int64)
    who, value = [], []
    first = np.cumsum(per) - per
    for step in (0, 1):
        todo = has
        for level in range(_LEVELS + 1):
            if not len(todo):
                break
            if level == 0:
                ids, vals, cnt = np.repeat(np.arange(len(per)), per), s, per
            else:
                ids = np.repeat(todo, per[todo])
                at = np.repeat(first[todo] - (np.cumsum(per[todo]) - per[todo]), per[todo]) + np.arange(len(ids))
                vals = TS.mix(s[at] ^ _SEED[level])
                order = np.lexsort((vals, ids))
                vals = vals[order]
            inst = band[ids] + step
            part = ((vals >> _U(32)) * n[inst].astype(np.uint64)) >> _U(32)
            new = np.ones(len(ids), bool)
            new[1:] = (ids[1:] != ids[:-1]) | (part[1:] != part[:-1])
            at = np.flatnonzero(new)
            tag = TS.mix(part[at] * _U(2 * _LEVELS + 9) + _U(level) + (inst[at].astype(np.uint64) << _U(40)))
            sig = TS.mix(_sums(TS.mix(vals ^ _SEED[3]), at) + tag)
            who.append(ids[at])
            value.append((sig & ~_U(1)) | (inst[at] & 1).astype(np.uint64))
            filled = np.bincount(ids[at], minlength=len(per))[todo]
            inst_ = band[todo] + step
            left = n[inst_] - k[inst_] - 1 - (n[inst_] - filled)
            if level == 0:
                spare[step, todo[left >= 0]] = left[left >= 0]
            todo = todo[left < 0]
        if len(todo):
            inst = band[todo] + step
            who.append(todo)
            value.append((TS.mix(inst.astype(np.uint64) * _SEED[2]) & ~_U(1)) | (inst & 1).astype(np.uint64))
    cat = lambda a, kind: np.concatenate(a) if a else np.zeros(0, kind)
    return cat(who, np.int64), cat(value, np.uint64), band, spare[0], spare[1]


def _sets(texts, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for lo, hi, counts, h in TS.words(texts):
        yield lo, hi, *TS.distinct(*TS.shingles(counts, h, k))


def _long(a: np.ndarray) -> pa.Array:
    return pa.array(a.view(np.int64) if a.dtype == np.uint64 else a)


def sketches(per: np.ndarray, s: np.ndarray) -> list[np.ndarray]:
    """Parity sketch of each set, as bytes; at least 256 bits, and 2 per element."""
    out, first = [], np.cumsum(per) - per
    h = TS.mix(s ^ _SEED[2])
    for a, c in zip(first.tolist(), per.tolist()):
        bits = 1 << max(8, int(2 * c - 1).bit_length()) if c else 256
        at = (h[a:a + c] & _U(bits - 1)).astype(np.int64)
        out.append(np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8), bitorder="little"))
    return out


def folded(x: np.ndarray, size: int) -> np.ndarray:
    """A sketch folded to ``size`` bytes."""
    while len(x) > size:
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    return x


def most_apart(a, b, num: int, den: int):
    """Elements in which linked sets of sizes ``a`` and ``b`` differ at most."""
    least_common = -((-num * (a + b)) // (num + den))
    return a + b - 2 * least_common


def _near(num: int, den: int):
    """Pairs whose sizes and sketches allow a link."""
    def run(batches):
        for b in batches:
            na, nb = np.asarray(b.column(2)), np.asarray(b.column(4))
            ok = (np.minimum(na, nb) * den >= np.maximum(na, nb) * num)
            most = most_apart(na, nb, num, den)
            for i in np.flatnonzero(ok):
                x, y = (np.frombuffer(b.column(c)[i].as_buffer(), np.uint8) for c in (3, 5))
                size = min(len(x), len(y))
                ok[i] = int(np.bitwise_count(folded(x, size) ^ folded(y, size)).sum(dtype=np.int64)) <= most[i]
            keep = pa.array(ok)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep)], ["u", "v"])
    return run


def _nodes(k: int, num: int, den: int):
    """What the operator needs of each row; columns after the text pass as they are."""
    def run(batches):
        for b in batches:
            more = b.schema.names[2:]
            for lo, hi, per, s in _sets(b.column(1), k):
                _, _, band, s0, s1 = signatures(per, s, num, den)
                sk = sketches(per, s)
                small = [folded(x, SKETCH).tobytes() for x in sk]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), _long(node_keys(per, s)), _long(per.astype(np.int64)),
                     pa.array(band.astype(np.int32)), pa.array(s0.astype(np.int32)), pa.array(s1.astype(np.int32)),
                     pa.array(small, pa.binary()), pa.array([x.tobytes() for x in sk], pa.binary()),
                     *[b.column(c).slice(lo, hi - lo) for c in range(2, 2 + len(more))]],
                    ["doc_id", "node", "n", "band", "s0", "s1", "small", "sketch", *more])
    return run


def _signed(k: int, num: int, den: int):
    def run(batches):
        seen: set[int] = set()
        for b in batches:
            for _, _, per, s in _sets(b.column(0), k):
                node = node_keys(per, s)
                fresh = np.zeros(len(node), bool)
                for i, x in enumerate(node.tolist()):
                    if x and x not in seen:
                        seen.add(x)
                        fresh[i] = True
                if len(seen) > _SEEN:
                    seen.clear()
                s = s[np.repeat(fresh, per)]
                who, value, *_ = signatures(per[fresh], s, num, den)
                yield pa.RecordBatch.from_arrays([_long(value), _long(node[fresh][who])], ["sig", "node"])
    return run


def _verified(pairs: DataFrame, rows: DataFrame, src: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """The pairs (u, v) whose sets link."""
    ends = lambda p: p.select(F.col("u").alias("node")).unionByName(p.select(F.col("v").alias("node"))).distinct()
    small = rows.join(ends(pairs), "node", "left_semi").groupBy("node").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    small = written(small, "sketches")
    of = lambda end, at: small.select(F.col("node").alias(end), F.col("n").alias(f"n{at}"), F.col("sketch").alias(f"s{at}"))
    met = pairs.join(of("v", 1), "v").join(of("u", 0), "u").select("u", "v", "n0", "s0", "n1", "s1")
    near = written(met.mapInArrow(_near(num, den), "u long, v long"), "near")

    # the sets themselves, from one row of documents each, found by id and text hash: ids may be null or repeat
    pick = (rows.select("node", "doc_id", "th").join(ends(near), "node", "left_semi").groupBy("node").agg(F.min(F.struct("doc_id", "th")).alias("r"))
            .select("node", F.xxhash64("r.doc_id").alias("__sl_id"), F.col("r.th").alias("__sl_th")))
    keyed = src.select("text", F.xxhash64("doc_id").alias("__sl_id"), F.xxhash64("text").alias("__sl_th"))
    text_of = keyed.join(pick, ["__sl_id", "__sl_th"]).select("node", "text")
    # equal rows repeat a set, and so a link
    sets = written(text_of.mapInArrow(_keyed_sets(k), "node long, items array<long>"), "items")
    a = sets.select(F.col("node").alias("u"), F.col("items").alias("a"))
    b = sets.select(F.col("node").alias("v"), F.col("items").alias("b"))
    both = F.size(F.array_intersect("a", "b"))
    links = written(near.join(b, "v").join(a, "u")
                    .withColumn("both", both)
                    .where(F.col("both") * den >= (F.size("a") + F.size("b") - F.col("both")) * num)
                    .select("u", "v"), "links")
    free_shuffles(src.sparkSession)
    return links


def _grouped(docs: DataFrame, id_col: str, text: str, k: int, num: int, den: int, hot: int) -> tuple[DataFrame, DataFrame]:
    """A row per row of ``docs`` (doc_id, node, n, ..., and ``th``, the text's
    hash), and the component of every node that has a link."""
    spark = docs.sparkSession
    doc_type = docs.schema[id_col].dataType.simpleString()
    src = docs.select(q(id_col).alias("doc_id"), q(text).cast("string").alias("text"))
    made = f"doc_id {doc_type}, node long, n long, band int, s0 int, s1 int, small binary, sketch binary, th long"
    rows = written(src.withColumn("th", F.xxhash64("text")).mapInArrow(_nodes(k, num, den), made), "sets")

    # signature groups with more than one node
    signed = src.select("text").mapInArrow(_signed(k, num, den), "sig long, node long")
    by = W.partitionBy("sig")
    live = written(signed.withColumns({"rep": F.min("node").over(by), "top": F.max("node").over(by)})
                   .where(F.col("rep") != F.col("top")).drop("top"), "groups")
    free_shuffles(spark)

    # every member against the least node of its group
    first = written(live.where(F.col("node") != F.col("rep")).select(F.col("rep").alias("u"), F.col("node").alias("v")).distinct(), "pairs")
    links = _verified(first, rows, src, k, num, den)
    comp = components(links)

    def labelled(groups: DataFrame) -> DataFrame:
        """Members of groups that still span components."""
        g = groups.select("sig", "node").join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        lo, hi = F.min("comp").over(by), F.max("comp").over(by)
        return g.withColumns({"lo": lo, "hi": hi}).where(F.col("lo") != F.col("hi"))

    # members outside the least node's component against the least of themselves
    left = written(labelled(live).select("sig", "node", "comp"), "open")
    least = F.min(F.struct("node", "comp"))
    rep = left.groupBy("sig").agg(least.alias("r"))
    outside = left.join(rep, "sig").where(F.col("comp") != F.col("r.comp")).drop("r")
    rep2 = outside.groupBy("sig").agg(least.alias("r"))
    second = (outside.join(rep2, "sig").where(F.col("comp") != F.col("r.comp"))
              .select(F.col("r.node").alias("u"), F.col("node").alias("v")).distinct())
    second = written(second, "pairs")
    tested = first
    if not second.isEmpty():
        comp = extended(comp, _verified(second, rows, src, k, num, den))
        tested = first.unionByName(second)

    # pairs across components: first one for every two components that some pair could join, then the rest
    for forest in (True, False):
        left = written(labelled(left).select("sig", "node", "comp"), "open")
        if left.isEmpty():
            break
        third = written(_across(left, rows, hot, num, den, forest).join(tested, ["u", "v"], "left_anti"), "pairs")
        if not third.isEmpty():
            comp = extended(comp, _verified(third, rows, src, k, num, den))
            tested = tested.unionByName(third)
    return rows, comp


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = K,
                    num: int = NUM, den: int = DEN, hot: int = HOT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, and the
    key ``node`` that equal sets share (0: empty set)."""
    rows, comp = _grouped(docs, id_col, text, k, num, den, hot)

    # labels: least doc_id of each component
    named = rows.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    least_id = named.where(F.col("node") != 0).groupBy("comp").agg(F.min("doc_id").alias("least"))
    return named.join(least_id, "comp", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("node") == 0, F.col("doc_id")).otherwise(F.col("least")).alias("component_id"), "node")


def _keyed_sets(k: int):
    """Sets under the key asked for, where the text really makes that key; once a task."""
    def run(batches):
        seen: set[int] = set()
        for b in batches:
            want = np.asarray(b.column(0)).view(np.uint64)
            for lo, hi, per, s in _sets(b.column(1), k):
                ok = node_keys(per, s) == want[lo:hi]
                for i in np.flatnonzero(ok):
                    x = int(want[lo + i])
                    ok[i] = x not in seen
                    seen.add(x)
                if len(seen) > _SEEN:
                    seen.clear()
                s = s[np.repeat(ok, per)]
                ends = np.concatenate([[0], np.cumsum(per[ok])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [_long(want[lo:hi][ok]), pa.ListArray.from_arrays(pa.array(ends), _long(s))], ["node", "items"])
    return run


def _across(left: DataFrame, rows: DataFrame, hot: int, num: int, den: int, forest: bool) -> DataFrame:
    """Pairs (u < v) of nodes of different components in one group, whose sizes
    and sketches allow a link (see ``llm.blocks``).

    Where a group costs more than ``hot`` pairs, nodes leave their largest
    groups first, as many as they can spare.
    """
    per = left.groupBy("sig", "comp").agg(F.count(F.lit(1)).alias("c"))
    size = (per.groupBy("sig").agg(F.max("c").alias("big"), F.sum("c").alias("all"))
            .select("sig", "all", ((F.col("all") - F.col("big")) * F.col("all") > hot).alias("hot")))
    may = rows.where(F.col("node") != 0).select("node", "n", "band", "s0", "s1").dropDuplicates(["node"])
    odd = F.col("sig").bitwiseAND(F.lit(1)).cast("int")
    g = (left.join(size, "sig").join(may, "node").withColumn("odd", odd)
         .withColumn("spare", F.when(F.pmod(F.col("band"), F.lit(2)) == F.col("odd"), F.col("s0")).otherwise(F.col("s1"))))
    # a node's signatures only, never a group's members
    nth = F.row_number().over(W.partitionBy("node", "odd").orderBy(F.col("hot").desc(), F.col("all").desc(), "sig"))
    g = written(g.withColumn("nth", nth).where(~F.col("hot") | (F.col("nth") > F.col("spare")))
                .select(F.col("sig").alias("t"), "node", "comp", "n"), "open")
    # what is left of the groups, where that is of two components still
    kept = (g.groupBy("t").agg(F.count(F.lit(1)).alias("all"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
            .where(F.col("lo") != F.col("hi")).select("t", "all"))
    sketch = rows.where(F.col("node") != 0).select("node", F.col("small").alias("sketch")).dropDuplicates(["node"])
    members = blocks.dealt(g.join(kept, "t").join(sketch, "node"), "all")
    return members.mapInArrow(blocks.pairs_of(num, den, forest), "u long, v long").distinct()


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = K,
                num: int = NUM, den: int = DEN, hot: int = HOT) -> DataFrame:
    """``docs`` with one row of each component: the first by doc_id (null
    last), then by the text's hash; of rows equal in both, any one.  Rows of
    the empty set are components of their own and all stay."""
    rows, comp = _grouped(docs, id_col, text, k, num, den, hot)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th"))
    nodes = rows.where(F.col("node") != 0).groupBy("node").agg(first.alias("r"))
    keep = (nodes.join(comp, "node", "left").groupBy(F.coalesce("comp", "node")).agg(F.min("r").alias("r"))
            .select(F.xxhash64("r.doc_id").alias("__sl_id"), F.col("r.th").alias("__sl_th")))
    t = q(text).cast("string")
    worded = F.coalesce(t.rlike(WORD), F.lit(False))
    # equal rows are of one node: an aggregate, combined map-side, leaves one of them
    d = (docs.where(worded).withColumns({"__sl_id": F.xxhash64(q(id_col)), "__sl_th": F.xxhash64(t)})
         .dropDuplicates(["__sl_id", "__sl_th"]).join(keep, ["__sl_id", "__sl_th"], "left_semi"))
    return d.select(*[q(c) for c in docs.columns]).unionByName(docs.where(~worded))
