"""Words of whole Arrow string columns as 64-bit hashes, in numpy.

A column's bytes are cut at separators (blank and the controls tab to carriage
return, all ASCII, so UTF-8 bytes will do), and every word is hashed from
prefix sums of a polynomial over random byte values.  Work goes in chunks of a
few megabytes whatever the length of a text; a text longer than a chunk is cut
between words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 21
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_BYTES = np.random.Generator(np.random.PCG64(20240601)).integers(1, 2 ** 63, 256, dtype=np.uint64) | _U(1)
_FOLDED = _BYTES.copy()
_FOLDED[65:91] = _BYTES[97:123]
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
_POWERS: dict[str, np.ndarray] = {}
_STEP = np.random.Generator(np.random.PCG64(7)).integers(1, 2 ** 63, 64, dtype=np.uint64) * _U(2) + _U(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, CHUNK)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            a = np.full(size, base, dtype=np.uint64)
            a[0] = 1
            _POWERS[name] = np.multiply.accumulate(a)
    return _POWERS["up"], _POWERS["down"]


def column(texts) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of an Arrow string array; nulls count as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    if not len(texts):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    off = np.frombuffer(texts.buffers()[1], kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    return off, np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)


def bounds(seg: np.ndarray, rel: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of ``seg``, texts beginning at ``rel``."""
    if not len(seg):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    sep = SEPARATOR[seg]
    cut = np.zeros(len(seg) + 1, bool)
    cut[rel] = True
    start = ~sep
    last = start.copy()
    start[1:] &= sep[:-1] | cut[1:-1]
    last[:-1] &= sep[1:] | cut[1:-1]
    return np.flatnonzero(start), np.flatnonzero(last) + 1


def hashes(seg: np.ndarray, start: np.ndarray, end: np.ndarray, fold: bool = True) -> np.ndarray:
    """Hash of each byte range ``start:end`` of ``seg``."""
    up, down = _powers(len(seg) + 1)
    sums = np.zeros(len(seg) + 1, np.uint64)
    np.cumsum((_FOLDED if fold else _BYTES)[seg] * up[:len(seg)], out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start])


def _cuts(data: np.ndarray, lo: int, hi: int) -> Iterator[tuple[int, int]]:
    """Parts of one long text, cut at separators."""
    while hi - lo > CHUNK:
        window = np.flatnonzero(SEPARATOR[data[lo + 1:lo + CHUNK]])
        step = int(window[-1]) + 1 if len(window) else CHUNK
        while not len(window) and lo + step < hi and not SEPARATOR[data[lo + step]]:
            step += 1  # one word longer than a chunk
        yield lo, lo + step
        lo += step
    yield lo, hi


def words(texts, fold: bool = True) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows ``lo:hi`` with the number of words of each and the words' hashes."""
    off, data = column(texts)
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + CHUNK, "right")) - 1)
        a, b = int(off[lo]), int(off[hi])
        if b - a <= CHUNK:
            seg, rel = data[a:b], off[lo:hi + 1] - a
            start, end = bounds(seg, rel)
            yield lo, hi, np.diff(np.searchsorted(start, rel)), hashes(seg, start, end, fold)
        else:
            got = []
            for x, y in _cuts(data, a, b):
                seg = data[x:y]
                got.append(hashes(seg, *bounds(seg, np.array([0])), fold))
            all_ = np.concatenate(got)
            yield lo, hi, np.array([len(all_)]), all_
        lo = hi


def windows(counts: np.ndarray, h: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words inside one text, in order, and how
    many each text has."""
    per = np.maximum(counts - size + 1, 0)
    if len(h) < size or not per.sum():
        return per, np.zeros(0, np.uint64)
    total = len(h) - size + 1
    s = np.zeros(total, np.uint64)
    for j in range(size):
        s += h[j:j + total] * _STEP[j]
    first = np.cumsum(counts) - counts
    inside = np.ones(total, bool)
    for j in range(1, size):  # a run starting in the last size-1 words of a text leaves it
        at = (first + counts - j)[counts >= j]
        inside[at[at < total]] = False
    return per, mix(s[inside])


def shingles(counts: np.ndarray, h: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Like ``windows``, and a text with 1 to ``size - 1`` words gives one run of all of them."""
    per, s = windows(counts, h, size)
    short = np.flatnonzero((counts > 0) & (counts < size))
    if not len(short):
        return per, s
    first = np.cumsum(counts) - counts
    one = np.zeros(len(short), np.uint64)
    for j in range(size - 1):
        has = counts[short] > j
        one[has] += h[first[short[has]] + j] * _STEP[j]
    one = mix(one + counts[short].astype(np.uint64) * _U(0xD1B54A32D192ED03))
    at = np.cumsum(per)[short]
    per = per.copy()
    per[short] = 1
    return per, np.insert(s, at, one)


def distinct(per: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct values of each text."""
    s = s.copy()
    ends = np.cumsum(per)
    lo = 0
    for hi in ends:
        if hi - lo > 1:
            s[lo:hi].sort()
        lo = hi
    if not len(s):
        return per, s
    keep = np.ones(len(s), bool)
    keep[1:] = s[1:] != s[:-1]
    first = (ends - per)[per > 0]
    keep[first] = True
    upto = np.concatenate([[0], np.cumsum(keep)])
    return np.diff(np.concatenate([[0], upto[ends]])), s[keep]
