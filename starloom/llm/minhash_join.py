"""Near duplicates by an inverted join over MinHash signature coordinates.

A document is the set of its distinct k-word shingles; equal sets are one node.
A node's signature holds ``M`` coordinates, the least value of its shingles
under ``M`` hashes, and two sets agree in a coordinate with the probability of
their similarity.  A pair is a candidate if it agrees in ``MATCH`` or more; sets
at the limit of a link (85 of 100) miss that with odds of 1.5 in ten million.

The join that finds them:

1. every coordinate and value is a posting.  An aggregate finds the postings
   that more than one node has and how often they occur; all others are left;
2. prefix: nodes order their postings by how rare they are.  Two nodes that
   agree in ``MATCH`` of ``M`` share one among the ``M - MATCH + 1`` rarest of
   each, so that only those are joined.  What a passage shared by many documents
   contributes is common and ends up behind the prefix;
3. in every posting list, members first meet its least node: a pair a member
   settles groups of near copies.  A pair's collisions are counted over the whole
   signatures; pairs above the threshold whose parity sketches allow a link (one
   bit per hash value modulo a power of two, whether an odd number of shingles
   has it: sketches differ in no more bits than the sets in shingles) are
   confirmed on the sets;
4. lists whose members are in one component by now are skipped.  The others are
   dealt into blocks (``llm.blocks``), and the same tests run between members
   of different components, a member sorted by size skipping those too large for
   a link.  Blocks of a list are held against each other in tasks of their own.
   A first pass sends on one pair for every two components that some pair could
   join, a spanning forest of candidates; once those are confirmed, a second pass
   sends all pairs that are left between different components.

The sets of all members of such lists are built once, in one pass over the
texts.  A list's pairs are never rows, only those that pass the tests are.  Step
4 costs time with the square of the members of a list that share a rare posting
and are in different components; in blocks these are byte comparisons.

Components are those of all links found; links are exact, but for clashes of
64-bit hashes.

Defined results: null or wordless text is the empty set, links with nothing and
is its own component, kept; 1 to k-1 words form one shingle; repeated rows and
repeated or null ids are rows like others (a component's id is the least id in
it, null if it has none; a row is kept if its id is that one, null equal to
null); very long texts are read whole; an empty table gives an empty result;
other columns of the input play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm import blocks
from starloom.llm import textscan as TS
from starloom.llm.blocks import BLOCK, apart, may_differ
from starloom.llm.common import Scratch, free_shuffles, q
from starloom.llm.components import components, extended

K = 3
NUM, DEN = 85, 100
M, MATCH = 64, 38
_U = np.uint64
_RNG = np.random.Generator(np.random.PCG64(1213))
_XOR, _TIMES, _TAG = (_RNG.integers(1, 2 ** 63, M, dtype=np.uint64) * _U(2) + _U(1) for _ in range(3))
#: Node keys a task remembers, so that copies sign once a task.
_SEEN = 200_000


def node_keys(per: np.ndarray, s: np.ndarray) -> np.ndarray:
    """One key per set: equal for equal sets, 0 for the empty one."""
    out = np.zeros(len(per), np.uint64)
    has = per > 0
    if has.any():
        sums = np.add.reduceat(TS.mix(s ^ _TAG[0]), (np.cumsum(per) - per)[has])
        out[has] = TS.mix(sums + per[has].astype(np.uint64) * _TIMES[0]) | _U(1)
    return out


def signatures(per: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Postings of sets that are not empty, a row of ``M`` per set."""
    first = np.cumsum(per) - per
    out = np.empty((len(per), M), np.uint64)
    for c in range(M):
        out[:, c] = np.minimum.reduceat((s ^ _XOR[c]) * _TIMES[c], first) if len(per) else 0
    return TS.mix(out ^ _TAG)


def collisions(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """In how many coordinates the short signatures agree."""
    return np.count_nonzero(a == b, axis=-1)


def sketches(per: np.ndarray, s: np.ndarray) -> list[np.ndarray]:
    """Parity sketch of each set, as bytes: 4 to 8 bits a shingle, 512 at least."""
    out, first = [], np.cumsum(per) - per
    h = TS.mix(s ^ _TAG[1])
    for a, c in zip(first.tolist(), per.tolist()):
        bits = 1 << max(9, int(4 * c - 1).bit_length())
        odd = np.bincount((h[a:a + c] & _U(bits - 1)).astype(np.int64), minlength=bits) & 1
        out.append(np.packbits(odd.astype(np.uint8), bitorder="little"))
    return out


def _short(column) -> np.ndarray:
    """Short signatures (the last 16 bits of every posting) of a binary column."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, M)


def _sets(texts, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for lo, hi, counts, h in TS.words(texts):
        yield lo, hi, *TS.distinct(*TS.shingles(counts, h, k))


def _long(a: np.ndarray) -> pa.Array:
    return pa.array(a.view(np.int64) if a.dtype == np.uint64 else a)


def _signed(k: int):
    """A row per document; the signature with the first row of a node in a task."""
    def run(batches):
        seen: set[int] = set()
        for b in batches:
            for lo, hi, per, s in _sets(b.column(2), k):
                node = node_keys(per, s)
                fresh = np.zeros(len(node), bool)
                for i, x in enumerate(node.tolist()):
                    if x and x not in seen:
                        seen.add(x)
                        fresh[i] = True
                if len(seen) > _SEEN:
                    seen.clear()
                sig = signatures(per[fresh], s[np.repeat(fresh, per)])
                ends = np.concatenate([[0], np.cumsum(np.where(fresh, M, 0))]).astype(np.int32)
                postings = pa.ListArray.from_arrays(pa.array(ends), _long(sig.reshape(-1)), mask=pa.array(~fresh))
                short = np.full(len(node), None, object)
                short[fresh] = [x.tobytes() for x in (sig & _U(0xFFFF)).astype(np.uint16)]
                sketch = np.full(len(node), None, object)
                sketch[fresh] = [x.tobytes() for x in sketches(per[fresh], s[np.repeat(fresh, per)])]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo), _long(node), _long(per.astype(np.int64)),
                     postings, pa.array(short, pa.binary()), pa.array(sketch, pa.binary())],
                    ["doc_id", "th", "node", "n", "postings", "short", "sketch"])
    return run


def _keyed_sets(k: int):
    """Sets under the key asked for, where the text makes that key; once a task."""
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


def _counted(match: int, num: int, den: int):
    """Pairs that agree in ``match`` coordinates or more, and whose sketches allow a link."""
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            na, nb = np.asarray(b.column(2)), np.asarray(b.column(5))
            ok = ((collisions(_short(b.column(3)), _short(b.column(6))) >= match)
                  & (np.minimum(na, nb) * den >= np.maximum(na, nb) * num))
            most = may_differ(na, nb, num, den)
            for i in np.flatnonzero(ok):
                x, y = (np.frombuffer(b.column(c)[i].as_buffer(), np.uint8) for c in (4, 7))
                ok[i] = apart(x, y) <= most[i]
            ok = pa.array(ok)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(ok), b.column(1).filter(ok)], ["u", "v"])
    return run


def _agreeing(match: int):
    """A further test of pairs in a part: coordinates that agree."""
    def part(column):
        short = _short(column)
        return lambda order, j, i: collisions(short[order[j]], short[order[i]]) >= match
    return part


def prefixes(sets: DataFrame, m: int = M, match: int = MATCH) -> DataFrame:
    """(t, node): postings within the prefix of each node that another node has."""
    posted = sets.where(F.col("postings").isNotNull()).select("node", F.explode("postings").alias("t"))
    live = (posted.groupBy("t").agg(F.count(F.lit(1)).alias("c"), F.min("node").alias("lo"), F.max("node").alias("hi"))
            .where(F.col("lo") != F.col("hi")).select("t", "c"))
    # of a node's own m postings: the live ones by rarity, behind those no other node has
    mine = posted.join(live, "t").groupBy("node").agg(F.sort_array(F.collect_set(F.struct("c", "t"))).alias("l"))
    spare = F.lit(m - match + 1) - (F.lit(m) - F.size("l"))
    return mine.where(spare > 0).select("node", F.explode(F.slice("l", F.lit(1), spare)).alias("p")).select("p.t", "node")


def links(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text: str = "text", k: int = K, num: int = NUM,
          den: int = DEN, match: int = MATCH, block: int = BLOCK) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A row per row of ``docs`` (doc_id, th, node, n), links between nodes that
    hold their components together, and (node, comp)."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    src = docs.select(q(id_col).alias("doc_id"), q(text).cast("string").alias("text"))
    sets = scratch.written(src.select("doc_id", F.xxhash64("text").alias("th"), "text").mapInArrow(
        _signed(k), f"doc_id {kind}, th long, node long, n long, postings array<long>, short binary, sketch binary"), "sets")

    prefix = scratch.written(prefixes(sets, M, match), "prefix")
    ends = prefix.groupBy("t").agg(F.min("node").alias("u"), F.max("node").alias("hi")).where(F.col("u") != F.col("hi")).drop("hi")
    lists = scratch.written(prefix.join(ends, "t"), "lists")
    free_shuffles(spark)
    member = lists.select("node").distinct()
    signed = scratch.written(sets.where(F.col("postings").isNotNull()).select("node", "n", "short", "sketch").join(member, "node", "left_semi")
                             .dropDuplicates(["node"]), "signed")
    # one row of the documents for the text of each member
    pick = (sets.join(member, "node", "left_semi").groupBy("node").agg(F.min(F.struct("doc_id", "th")).alias("r"))
            .select(F.col("node").alias("__sl_node"), F.xxhash64("r.doc_id").alias("__sl_id"), F.col("r.th").alias("__sl_th")))
    texts = (src.select("text", F.xxhash64("doc_id").alias("__sl_id"), F.xxhash64("text").alias("__sl_th"))
             .join(pick, ["__sl_id", "__sl_th"]).select("__sl_node", "text"))
    items = scratch.written(texts.mapInArrow(_keyed_sets(k), "node long, items array<long>"), "items")
    free_shuffles(spark)

    def counted(pairs: DataFrame) -> DataFrame:
        """Those of ``pairs`` (u, v) that may link."""
        of = lambda end, at: signed.select(F.col("node").alias(end), *[F.col(c).alias(f"{c}{at}") for c in ("n", "short", "sketch")])
        met = pairs.distinct().join(of("v", 1), "v").join(of("u", 0), "u")
        return scratch.written(met.select("u", "v", "n0", "short0", "sketch0", "n1", "short1", "sketch1")
                               .mapInArrow(_counted(match, num, den), "u long, v long"), "pairs")

    def confirmed(pairs: DataFrame) -> DataFrame:
        """Those of ``pairs`` whose sets link."""
        a = items.select(F.col("node").alias("u"), F.col("items").alias("a"))
        b = items.select(F.col("node").alias("v"), F.col("items").alias("b"))
        both = F.size(F.array_intersect("a", "b"))
        return scratch.written(pairs.join(b, "v").join(a, "u").withColumn("both", both)
                               .where(F.col("both") * den >= (F.size("a") + F.size("b") - F.col("both")) * num)
                               .select("u", "v").distinct(), "links")

    def named(groups: DataFrame, comp: DataFrame) -> DataFrame:
        """Members of the lists that still span components."""
        g = groups.select("t", "node").join(comp, "node", "left").select("t", "node", F.coalesce("comp", "node").alias("comp"))
        still = (g.groupBy("t").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("all"))
                 .where(F.col("lo") != F.col("hi")).select("t", "all"))
        return scratch.written(g.join(still, "t"), "open")

    # every member against the least node of its lists
    tested = counted(lists.where(F.col("u") != F.col("node")).select("u", F.col("node").alias("v")))
    found = confirmed(tested)
    comp = components(found)
    free_shuffles(spark)

    # what still spans components, in blocks
    left = lists
    for forest in (True, False):
        left = named(left, comp)
        if left.isEmpty():
            break
        parts = blocks.dealt(left.join(signed, "node"), "all", block)
        pairs = parts.mapInArrow(blocks.pairs_of(num, den, forest, _agreeing(match)), "u long, v long").distinct()
        pairs = scratch.written(pairs.join(tested, ["u", "v"], "left_anti"), "pairs")
        if not pairs.isEmpty():
            new = confirmed(pairs)
            tested, found = tested.unionByName(pairs), found.unionByName(new)
            comp = extended(comp, new)
        free_shuffles(spark)
    return sets.select("doc_id", "th", "node", "n"), found, comp


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = K, num: int = NUM,
                    den: int = DEN, match: int = MATCH, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept, and
    the key ``node`` that equal sets share (0: empty set)."""
    with Scratch(docs.sparkSession, "minhash") as scratch:
        rows, _, comp = links(docs, scratch, id_col, text, k, num, den, match, block)
        named = rows.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        least = named.where(F.col("node") != 0).groupBy("comp").agg(F.min("doc_id").alias("least"))
        label = F.when(F.col("node") == 0, F.col("doc_id")).otherwise(F.col("least"))
        return scratch.result(named.join(least, "comp", "left").select(
            "doc_id", F.col("n").alias("n_shingles"), label.alias("component_id"),
            F.col("doc_id").eqNullSafe(label).alias("kept"), "node"))
