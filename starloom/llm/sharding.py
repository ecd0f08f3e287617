"""Sharding by a permutation-filled lookup table.

Each shard has its own preference order over the slots of a prime-sized table
(``offset + j * skip`` modulo the prime, both from a digest of its name).
Shards take turns claiming the next free slot of their order until the table
is full, so every shard owns either ``floor`` or ``ceil`` of an equal part, and
adding or removing one shard moves few slots of the others.  Placing a row is
one digest, one remainder and one lookup in the table, which is broadcast: its
size is the prime, a parameter, and does not grow with the data.

Defined results: a row whose key is null is placed by its text, so null keys
spread over the shards; with text null too it goes where the empty text goes.
Rows with equal keys always share a shard.  An input column called like the
output column is replaced.  Empty input gives empty output.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import q, unused

SLOTS = 65537  # prime, thousands of slots a shard
SHARDS = tuple(f"shard-{i:02d}" for i in range(16))
_SLOT, _TO = "__sl_slot", "__sl_to"


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def lookup_table(shards: Sequence[str], slots: int = SLOTS) -> list[int]:
    """Slot -> index of the shard that claimed it."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shard names must be given and distinct")
    if not _is_prime(slots) or slots < len(shards):
        raise ValueError("the table size must be a prime of at least the number of shards")
    at, skip = [], []
    for name in shards:
        digest = hashlib.sha256(name.encode()).digest()
        at.append(int.from_bytes(digest[:8], "big") % slots)
        skip.append(int.from_bytes(digest[8:16], "big") % (slots - 1) + 1 if slots > 2 else 1)
    owner, free = [-1] * slots, slots
    while free:
        for s in range(len(shards)):
            while owner[at[s]] >= 0:
                at[s] = (at[s] + skip[s]) % slots
            owner[at[s]] = s
            free -= 1
            if not free:
                break
    return owner


def slot_of(key: Column, slots: int) -> Column:
    """First 32 bits of the key text's md5, modulo the table size."""
    return F.pmod(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long"), F.lit(slots)).cast("int")


def place(df: DataFrame, key: str = "doc_id", text: str = "text", shards: Sequence[str] = SHARDS,
          slots: int = SLOTS, out: str = "shard") -> DataFrame:
    """``df`` with its shard's name in ``out``."""
    spark = df.sparkSession
    owner = lookup_table(shards, slots)
    schema = T.StructType([T.StructField(_SLOT, T.IntegerType(), False), T.StructField(_TO, T.StringType(), False)])
    lookup = spark.createDataFrame([(i, shards[s]) for i, s in enumerate(owner)], schema)
    by_key = q(key).cast("string")
    if text in df.columns:
        by_key = F.coalesce(by_key, F.concat(F.lit("text:"), F.coalesce(q(text), F.lit(""))))
    else:
        by_key = F.coalesce(by_key, F.lit("text:"))
    kept = unused(df.columns, out)
    return (df.withColumn(_SLOT, slot_of(by_key, slots))
            .join(F.broadcast(lookup), _SLOT, "inner")
            .select(*[q(c) for c in kept], F.col(_TO).alias(out)))
