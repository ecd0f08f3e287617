"""Mixing sources to target weights by entropy balancing.

Documents carry a base mass (their words).  The mix keeps as close to that
base as possible, in relative entropy, while the words of every source meet a
target.  The convex dual has one multiplier per source and level of any other
constraint; Newton steps on it need only the tilted mass of each level, a
distributed aggregate.  A document's rate is ``exp`` of the multipliers that
apply to it.

Documents are pre-aggregated to cells (one per combination of constraint
levels) before the first step, so a source holding a third of all rows is one
partial sum per map task.  Rates are then rounded into whole copies: floor of
the rate for all, one more for a systematic pick down the documents of a
source in order of size, and a last adjustment of a few documents a source so
that the words taken land on the target.  The pick numbers documents within
(source, size band, salt) groups of bounded size and joins their offsets, so
no source is sorted in one task.

All of it is DataFrame work; the driver reads single numbers (sums, the worst
residual) only.

Defined results: null text has size 0; null source is a source of its own and
ordered last; sources without words get target 0 and rate 0; null and repeated
doc_ids are rows like others; an empty table gives an empty result; input
columns never clash with the operator's, which are prefixed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from starloom.llm.common import q, word_count, written
from starloom.operators.keys import dense_key

WEIGHTS = (5.0, 2.0, 1.0)
MAX_RATE = 3.0
#: Rows a numbering group should hold at most, about.
GROUP_ROWS = 250_000
_P = "__sl_"


def source_targets(mass: DataFrame, weights: Sequence[float] = WEIGHTS, max_rate: float = MAX_RATE) -> DataFrame:
    """``mass`` (level, base) with its ``target``.

    Levels in code point order, null last, weigh ``weights`` in turn and share
    the total; no target passes ``max_rate`` times its base, and what is above
    is shared again by weight among the others until none is above.
    """
    numbered = dense_key(mass, ["level"], "pos")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.pmod(F.col("pos") - 1, F.lit(len(weights))) + 1).cast("int"))
    src = written(numbered.withColumn("weight", w).withColumn("most", F.col("base") * F.lit(float(max_rate))), "sources")
    total = float(src.agg(F.coalesce(F.sum("base"), F.lit(0))).first()[0])
    share, full = 0.0, F.lit(False)
    known = -1
    while True:  # ends: each turn fills at least one more level
        row = src.agg(F.coalesce(F.sum(F.when(full, F.col("most"))), F.lit(0.0)).alias("taken"),
                      F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)).alias("open"),
                      F.count(F.when(full, 1)).alias("n")).first()
        if row["n"] == known or row["open"] == 0:
            break
        known = row["n"]
        share = (total - row["taken"]) / row["open"]
        full = full | (F.col("most") < F.col("weight") * F.lit(share))
    target = F.when(full, F.col("most")).otherwise(F.col("weight") * F.lit(share))
    return src.select("level", "base", F.when(F.col("base") > 0, target).otherwise(F.lit(0.0)).alias("target"))


def entropy_balance(cells: DataFrame, base: str, targets: dict[str, DataFrame], steps: int = 100,
                    tolerance: float = 1e-9) -> DataFrame:
    """``cells`` with ``rate``: exp of the multipliers that solve the dual.

    ``targets`` maps a constraint column of ``cells`` to its (level, target).
    Every Newton step aggregates the tilted mass per level; the Hessian block
    of one constraint column is diagonal (levels are disjoint), and several
    constraint columns take turns.  Steps are cut to one unit, for Newton on an
    exponential overshoots from below.
    """
    state = cells.withColumn("tilt", F.lit(0.0))
    for col, goal in targets.items():
        g = goal.select(F.col("level").alias(_P + "l"), F.col("target").alias(_P + "t_" + col))
        state = state.join(g, state[col].eqNullSafe(g[_P + "l"]), "left").drop(_P + "l")
    state = written(state, "dual")
    tilted = F.col(base) * F.exp("tilt")
    for _ in range(steps):
        worst = 0.0
        for col in targets:
            t = F.col(_P + "t_" + col)
            now = state.groupBy(col).agg(F.sum(tilted).alias(_P + "m"))
            state = state.join(now.withColumnRenamed(col, _P + "l"), F.col(col).eqNullSafe(F.col(_P + "l")), "left")
            live = (F.col(_P + "m") > 0) & (t > 0)
            step = F.when(live, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (t - F.col(_P + "m")) / F.col(_P + "m")))).otherwise(0.0)
            off = F.when(live, F.abs(t - F.col(_P + "m")) / t).otherwise(0.0)
            state = written(state.withColumn(_P + "off", off).withColumn("tilt", F.col("tilt") + step).drop(_P + "l", _P + "m"), "dual")
            worst = max(worst, float(state.agg(F.coalesce(F.max(_P + "off"), F.lit(0.0))).first()[0]))
            state = state.drop(_P + "off")
        if worst <= tolerance:
            break
    alive = F.lit(True)
    for col in targets:
        alive = alive & (F.coalesce(F.col(_P + "t_" + col), F.lit(0.0)) > 0)
    return state.withColumn("rate", F.when(alive & (F.col(base) > 0), F.exp("tilt")).otherwise(0.0)).drop(
        "tilt", *[_P + "t_" + c for c in targets])


def _copies(rows: DataFrame, src: DataFrame, max_rate: float) -> DataFrame:
    """``rows`` (id columns, level, size, tie) with source columns and ``copies``."""
    src = src.withColumn("rate", F.least(F.col("rate"), F.lit(max_rate)))
    whole = F.floor(F.col("rate") + F.lit(1e-9))
    src = (src.withColumn("whole", whole.cast("long"))
           .withColumn("part", F.greatest(F.lit(0.0), F.col("rate") - whole))
           .withColumn("salts", F.greatest(F.lit(1), F.ceil(F.col("docs") / F.lit(8.0 * GROUP_ROWS))).cast("int")))
    src = src.withColumnRenamed("level", _P + "l")
    d = rows.join(src, F.col("level").eqNullSafe(F.col(_P + "l")), "inner").drop(_P + "l")
    band = F.floor(F.log2(F.col("size") + 1) * 4).cast("int")
    salt = F.pmod(F.col("tie"), F.col("salts")).cast("int")
    d = d.withColumns({"band": band, "salt": salt})
    group = ["cell", "band", "salt"]
    before = (d.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
              .withColumn("offset", F.sum("n").over(W.partitionBy("cell").orderBy(F.desc("band"), "salt")) - F.col("n"))
              .drop("n"))
    nth = F.row_number().over(W.partitionBy(*group).orderBy(F.desc("size"), "tie", F.col("doc_id").asc_nulls_last()))
    d = d.withColumn("nth", nth).join(before, group, "inner").withColumn("nth", F.col("nth") + F.col("offset"))
    upto = lambda n: F.floor(n * F.col("part") + F.lit(0.5))
    d = written(d.withColumn("extra", (upto(F.col("nth")) - upto(F.col("nth") - 1)).cast("int"))
                .drop("offset", "salt", "salts", "tie"), "picked")

    # One or two documents of every size band may still move, largest first,
    # as long as they fit into what a source lacks or has too much.
    one = F.struct("size", "nth")
    movable = (d.where((F.col("part") > 0) & (F.col("size") > 0)).groupBy("cell", "extra", "band")
               .agg(F.max(one).alias("a"), F.min(one).alias("b"))
               .withColumn("m", F.explode(F.array_distinct(F.array("a", "b"))))
               .groupBy("cell", "extra").agg(F.sort_array(F.collect_list("m"), asc=False).alias("m")))
    off = (d.groupBy("cell").agg(F.first("target").alias("target"), F.sum(F.col("size") * (F.col("whole") + F.col("extra"))).alias("now"))
           .select("cell", (F.col("target") - F.col("now")).alias("off")))
    start = F.struct(F.abs("off").alias("left"), F.array().cast("array<bigint>").alias("ids"))
    step = lambda s, m: F.when(m["size"] <= s["left"], F.struct((s["left"] - m["size"]).alias("left"),
                                                                F.concat(s["ids"], F.array(m["nth"].cast("bigint"))).alias("ids"))).otherwise(s)
    moves = (movable.join(off, "cell").where(F.col("extra") == F.when(F.col("off") > 0, 0).otherwise(1))
             .select("cell", F.explode(F.aggregate("m", start, step, lambda s: s["ids"])).alias("nth"),
                     F.signum("off").cast("int").alias("move")))
    return (d.join(moves, ["cell", "nth"], "left")
            .withColumn("copies", (F.col("whole") + F.col("extra") + F.coalesce(F.col("move"), F.lit(0))).cast("int"))
            .drop("whole", "extra", "move", "nth", "band", "part"))


def mix(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
        weights: Sequence[float] = WEIGHTS, max_rate: float = MAX_RATE, keep: Sequence[str] = ()) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, rate,
    copies, taken; then the columns named in ``keep`` in a struct ``kept``."""
    tie = F.xxhash64(q(id_col).cast("string"), q(text).cast("string"))
    cols = [q(id_col).alias("doc_id"), q(source).cast("string").alias("level"), word_count(q(text)).alias("size"), tie.alias("tie")]
    if keep:
        cols.append(F.struct(*[q(c).alias(c) for c in keep]).alias("kept"))
    rows = written(docs.select(*cols), "sizes")
    mass = rows.groupBy("level").agg(F.sum("size").alias("base"), F.count(F.lit(1)).alias("docs"))
    mass = written(mass, "mass")
    goal = written(source_targets(mass.drop("docs"), weights, max_rate), "targets")
    cells = entropy_balance(mass, "base", {"level": goal.select("level", "target")})
    g = goal.select(F.col("level").alias(_P + "l"), "target")
    src = written(cells.join(g, F.col("level").eqNullSafe(F.col(_P + "l"))).drop(_P + "l")
                  .withColumnRenamed("base", "source_size")
                  .withColumn("cell", F.xxhash64(F.coalesce(F.concat(F.lit("s"), "level"), F.lit("n")))), "rates")
    out = _copies(rows, src, max_rate)
    return out.select("doc_id", "size", "source_size", "target", "rate", "copies",
                      (F.col("copies") * F.col("size")).cast("long").alias("taken"), *(["kept"] if keep else []))


def repeated(docs: DataFrame, **args) -> DataFrame:
    """The mix itself: every row of ``docs``, with its columns, as many times
    as it has copies."""
    mixed = mix(docs, keep=docs.columns, **args).where(F.col("copies") > 0)
    times = F.explode(F.sequence(F.lit(1), F.col("copies")))
    return mixed.select("kept", times.alias(_P + "i")).select(
        *[F.col("kept").getField(c).alias(c) for c in docs.columns])
