"""Deduplication and surrogate keys.

Scale notes
-----------
* ``keep_first`` is an aggregate, not a window: ``min(struct(tiebreak..., rest...))``
  per key is combined map-side, so a natural key holding a third of all rows
  is cut down to one row per map task before the shuffle.
* ``dense_key`` numbers rows 1..n in key order without a single-task global
  window: rows are range-partitioned on the key into slices (coalesced by AQE
  unless ``num_buckets`` fixes their number),
  sorted and tagged with their position inside the slice, checkpointed once,
  and shifted by the row count of all earlier slices.  The slice counts, one
  number per slice, are the only values that reach the driver.  Numbering
  depends only on the key values, not on input order or on where the range
  bounds fall.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.lookups import known_top, remember_bytes, remember_rows, remember_top
from starloom.session import ensure_checkpoint_dir

_PID, _SEQ, _N = "__sl_pid", "__sl_seq", "__sl_n"


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def keep_first(df: DataFrame, keys, order_by: Sequence[str] | None = None) -> DataFrame:
    """One row per ``keys``: the first by ``order_by`` ascending, then by the
    remaining columns, so the choice is repeatable whatever the input order.

    Null keys form one group, as in a pandas ``drop_duplicates``.
    """
    keys = _names(keys)
    order_by = [c for c in (order_by or []) if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    payload = order_by + rest
    if not payload:
        return df.select(*keys).distinct()
    picked = df.groupBy(*keys).agg(F.min(F.struct(*payload)).alias("__sl_first"))
    out = picked.select(*keys, *[F.col("__sl_first." + c).alias(c) for c in payload])
    return out.select(*df.columns)


def _ordering(cols: Sequence[str], nulls_last: bool = True) -> list[Column]:
    return [F.col(c).asc_nulls_last() if nulls_last else F.col(c).asc_nulls_first() for c in cols]


def dense_key(df: DataFrame, order_cols, key_name: str, num_buckets: int | None = None,
              first: int = 1) -> DataFrame:
    """Add ``key_name`` = first, first+1, ... in ``order_cols`` order (nulls last).

    ``order_cols`` must be unique per row (a natural key) for the numbering to
    be repeatable.
    """
    order_cols = _names(order_cols)
    spark = df.sparkSession
    # Without an explicit count the range exchange may be coalesced by AQE:
    # neighbouring ranges merge, so slices stay contiguous and ordered, and a
    # small dimension ends up in few slices instead of one per shuffle partition.
    ranged = (df.repartitionByRange(*_ordering(order_cols)) if num_buckets is None
              else df.repartitionByRange(max(1, int(num_buckets)), *_ordering(order_cols)))
    ordered = ranged.sortWithinPartitions(*_ordering(order_cols))
    # monotonically_increasing_id = (partition index << 33) + row index in partition
    tagged = ordered.withColumns({_PID: F.spark_partition_id(),
                                  _SEQ: F.monotonically_increasing_id()})
    # Materialize once in the shared checkpoint folder.  The per-slice counts
    # and the numbering must see the very same slices; left as two plan
    # branches, the optimizer prunes them differently and each would draw its
    # own range-bound sample.
    ensure_checkpoint_dir(spark)
    tagged = tagged.checkpoint(eager=True)
    # Row count per slice: one small number per slice (at most the shuffle
    # partition count), read once on the driver and folded into the key
    # expression as a literal offset table.
    texts = [c for c in order_cols if df.schema[c].dataType.typeName() == "string"]
    width = sum([F.coalesce(F.octet_length(c), F.lit(0)) for c in texts], F.lit(0))
    slices = tagged.groupBy(_PID).agg(F.count(F.lit(1)).alias(_N), F.sum(width).alias("bytes")).collect()
    sizes = {r[_PID]: r[_N] for r in slices}
    offsets, running = [], 0
    for pid in range(max(sizes, default=0) + 1):
        offsets.append(running)
        running += int(sizes.get(pid, 0))
    offset = F.element_at(F.array(*[F.lit(o).cast("long") for o in offsets]),
                          F.col(_PID) + F.lit(1))
    local_index = F.col(_SEQ) - F.shiftleft(F.col(_PID).cast("long"), 33)
    numbered = tagged.withColumn(key_name, (offset + local_index + F.lit(first)).cast("long"))
    out = remember_bytes(numbered.drop(_PID, _SEQ), sum(r["bytes"] or 0 for r in slices))
    return remember_top(remember_rows(out, running), first + running - 1)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row dedupe; partial aggregation keeps it skew-safe."""
    return df.distinct()


def keep_existing_keys(new_members: DataFrame, previous_dim: DataFrame, natural_key,
                       key_name: str, num_buckets: int | None = None) -> DataFrame:
    """Stable keys across refreshes: members already in ``previous_dim`` keep
    their key; new members are numbered after the previous maximum.
    """
    natural_key = _names(natural_key)
    prev = previous_dim.select(*natural_key, key_name)
    known = new_members.join(prev, natural_key, "inner")
    fresh = new_members.join(prev, natural_key, "left_anti")
    # one scalar, read once on the driver
    start = previous_dim.agg(F.coalesce(F.max(key_name), F.lit(0))).first()[0]
    fresh_keyed = dense_key(fresh, natural_key, key_name, num_buckets=num_buckets,
                            first=int(start) + 1)
    return remember_top(known.unionByName(fresh_keyed), known_top(fresh_keyed))
