"""Blocks of numbers packed into one binary value, and rows dealt by bucket.

A task that would send many small rows sends a few binary values instead:
numbers of one kind are stored byte plane by byte plane, so that zstd shrinks
the sorted and the small ones.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def pack(*columns: np.ndarray) -> bytes:
    """Unsigned columns of equal length, 4 or 8 bytes a value, as bytes."""
    n = len(columns[0])
    raw = b"".join(np.ascontiguousarray(c).view(np.uint8).reshape(n, c.itemsize).T.tobytes() for c in columns)
    return np.uint64(n).tobytes() + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(blob: bytes, *kinds) -> list[np.ndarray]:
    """The columns that ``pack`` was given, of the dtypes ``kinds``."""
    n = int(np.frombuffer(blob, np.uint64, 1)[0])
    sizes = [np.dtype(k).itemsize for k in kinds]
    raw = np.frombuffer(pa.decompress(blob[8:], n * sum(sizes), codec="zstd", asbytes=True), np.uint8)
    out, at = [], 0
    for kind, size in zip(kinds, sizes):
        out.append(np.ascontiguousarray(raw[at:at + n * size].reshape(size, n).T).view(kind).reshape(n))
        at += n * size
    return out


def steps(values: np.ndarray) -> np.ndarray:
    """Sorted values as differences, the first from zero."""
    return np.diff(values, prepend=values.dtype.type(0))


def dealt(df: DataFrame, buckets: int, *then: str) -> DataFrame:
    """Rows with the column ``bucket`` (0 to ``buckets - 1``), one task a
    bucket, in the order of ``then``."""
    return df.repartitionById(buckets, df["bucket"]).sortWithinPartitions("bucket", *then)


def lists(values: pa.Array, lengths: np.ndarray) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), values)
