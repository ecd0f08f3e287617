"""Benchmark decontamination by template canonicalisation.

Words become templates: numbers, capitalised words and units turn into typed
placeholders, other words are lower-cased without the punctuation around them.
Currency signs, names before "=" and what is attached behind a number stand
apart from it ("$5", "x=3", "5kg", "5-km").  Windows of template words of every
text are hash-joined with those of the benchmark items; a match counts when its
slots are consistent, that is, the item's values map to the text's one to one.
In a window with fewer literal words than half, or of under ``LEAST`` words,
placeholders alone would match too much: it matches on its exact values.

Defined results: null and wordless texts and items match nothing; an item
shorter than the window is one window of all its words (one of a single word
matches every text with that word); repeated rows are reported each; an empty table on either side
gives an empty result; other columns play no part.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import q

WINDOW, LEAST = 13, 6
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_TRIM = ".,;:!?\"'()[]{}"
_NUM = re.compile(r"[+-]?\d[\d.,:/%]*$")
#: Name or sign before a number, currency, number, and letters or a unit behind it.
_GLUED = re.compile(r"((?:[^\W\d]\w*+)?[=<>\u2264\u2265~\u2248\u00b1#]+)?([+-]?)((?:[A-Za-z]{1,2})?[$\u20ac\u00a3\u00a5])?([+-]?\d(?:[.,:/%]*+\d)*+%?)([^\d]*+)")
# fixed values: unit words that templates hide
UNITS = frozenset("mm cm m km g kg mg l ml s ms min h km/h mph usd eur $ € % °c °f mb gb tb".split())


def _apart(bare: str, low: str) -> list[tuple[str, str]] | None:
    """Pieces of a word in which a number stands with other signs."""
    m = _GLUED.fullmatch(low) if not bare.isalpha() else None
    if m is None:
        return None
    lead, sign, currency, number, rest = m.groups()
    rest = rest.strip(_TRIM + "-\u2013")
    out = [(lead, lead)] if lead else []
    out += [("<unit>", currency)] if currency else []
    out.append(("<num>", sign + number))
    return out + ([("<unit>" if rest in UNITS else rest, rest)] if rest else [])


def _pieces(w: str) -> list[tuple[str, str]]:
    bare = w.strip(_TRIM) or w
    low = bare.lower()
    if _NUM.match(bare):
        return [("<num>", low)]
    if low in UNITS:
        return [("<unit>", low)]
    return _apart(bare, low) or [("<name>" if bare[:1].isupper() else low, low)]


#: Words whose pieces a task remembers.
_KNOWN = 100_000


def template(text: str | None, known: dict | None = None) -> list[tuple[str, str]]:
    """(placeholder or literal, value) of each word; ``known`` holds words met before."""
    known, out = {} if known is None else known, []
    for w in _WORD.findall(text or ""):
        got = known.get(w)
        if got is None:
            if len(known) >= _KNOWN:
                known.clear()
            got = known[w] = _pieces(w)
        out += got
    return out


def _exact(words) -> str:
    """Key of a window that matches on its values; no word holds a line break."""
    return "\n".join(["\x1f".join(k for k, _ in words), "\x1f".join(v for _, v in words)])


def _windows(words, size):
    """Key and place of each window: its template, or its template and values."""
    literal = [k[0] != "<" for k, _ in words]
    for i in range(len(words) - size + 1):
        if size >= LEAST and 2 * sum(literal[i:i + size]) >= size:
            yield "\x1f".join(k for k, _ in words[i:i + size]), i
        else:
            yield _exact(words[i:i + size]), i


def _consistent(a: list[str], b: list[str]) -> bool:
    ab, ba = {}, {}
    return all(ab.setdefault(x, y) == y and ba.setdefault(y, x) == x for x, y in zip(a, b))


class _Words(dict):
    """Numbers of the words met, and hashes of their pieces' kinds and values."""

    def __init__(self):
        super().__init__()
        self.kinds, self.values, self.counts, self.n = [], [], [], 0
        self.unit, self.name = hash("<unit>"), hash("<name>")  # of this process

    def __missing__(self, w):
        n = self[w] = self.n
        self.n += 1
        bare = w.strip(_TRIM)
        if bare.isalpha():  # one piece: most words
            low = bare.lower()
            v = hash(low)
            self.kinds.append(self.unit if low in UNITS else self.name if bare[0].isupper() else v)
            self.values.append(v)
            self.counts.append(1)
        else:
            got = _pieces(w)
            self.kinds += [hash(k) for k, _ in got]
            self.values += [hash(v) for _, v in got]
            self.counts.append(len(got))
        return n

    def forget(self):
        self.clear()
        self.n = 0
        for part in (self.kinds, self.values, self.counts):
            part.clear()


#: Words whose windows are hashed at once.
_AT_ONCE = 1 << 18
_BASE = 0x9E3779B97F4A7C15


def _sums(hashes, size: int):
    """(s, hashes of the windows of s pieces by place), for s up to ``size``."""
    out, power = np.zeros(len(hashes) + 1, np.uint64), 1
    for s in range(1, size + 1):
        out = out[:-1] + hashes[s - 1:] * np.uint64(power)
        if not len(out):
            return
        power = power * _BASE % (1 << 64)
        yield s, out


def _window_hash(pieces) -> int:
    return sum(hash(x) * pow(_BASE, j, 1 << 64) for j, x in enumerate(pieces)) % (1 << 64)


class _Member:
    """A set of 64-bit hashes; most that are not in it are told by their first bits."""

    def __init__(self, hashes):
        self.hashes = np.unique(np.array(list(hashes), np.uint64))
        bits = max(16, (16 * len(self.hashes)).bit_length())
        self.shift, self.may = np.uint64(64 - bits), np.zeros(1 << bits, bool)
        self.may[self.hashes >> self.shift] = True

    def places(self, hashes):
        at = np.flatnonzero(self.may[hashes >> self.shift])
        return at[np.isin(hashes[at], self.hashes)]


class _Known:
    """The items' windows by size and key; texts meet them by hashes of their
    windows first, and the keys themselves decide."""

    def __init__(self, table: dict):
        self.table, self.size = table, max(table, default=0)
        # a word that holds the sign between words: such keys are tried at every place
        self.odd = {s for s, t in table.items() if any("\n" not in k and k.count("\x1f") != s - 1 for k in t)}
        self.templates = {s: _Member(_window_hash(k.split("\x1f")) for k in t if "\n" not in k) for s, t in table.items()}
        self.exact = {s: _Member(_window_hash(slots) for k, hits in t.items() if "\n" in k for _, slots in hits) for s, t in table.items()}

    def met(self, words: _Words, texts):
        """(id, {item: windows}) of every text that meets an item."""
        ids, flat, n = [], [], 0
        for i, t in texts:
            w = _WORD.findall(t or "")
            flat.append(np.fromiter(map(words.__getitem__, w), np.int64, len(w)))
            ids.append(i)
            n += len(w)
            if n >= _AT_ONCE or len(words) >= _KNOWN:
                yield from self._met(words, ids, flat)
                ids, flat, n = [], [], 0
                if len(words) >= _KNOWN:
                    words.forget()
        yield from self._met(words, ids, flat)

    def _met(self, words, ids, texts):
        if not texts or not self.table:
            return
        ends, flat = np.cumsum([len(t) for t in texts]), np.concatenate(texts)
        counts = np.array(words.counts, np.int64)
        first = np.cumsum(counts) - counts
        per = counts[flat]
        begin = np.cumsum(per) - per  # of every word, in pieces
        of = np.repeat(first[flat] - begin, per) + np.arange(per.sum())
        stop = np.concatenate([[0], np.cumsum(per)])[ends]  # of every text, in pieces
        word = list(words)
        kinds = np.array(words.kinds, np.int64).view(np.uint64)[of]
        values = np.array(words.values, np.int64).view(np.uint64)[of]
        found: dict = {}
        for (s, k), (_, v) in zip(_sums(kinds, self.size), _sums(values, self.size)):
            if s not in self.table:
                continue
            table = self.table[s]
            for exact, at in ((False, np.arange(len(k)) if s in self.odd else self.templates[s].places(k)), (True, self.exact[s].places(v))):
                text = np.searchsorted(stop, at, "right")
                for p, n in zip(at.tolist(), text.tolist()):
                    if p + s > stop[n]:  # runs into the next text
                        continue
                    a, z = np.searchsorted(begin, [p, p + s - 1], "right") - 1
                    w = [x for m in flat[a:z + 1].tolist() for x in _pieces(word[m])][p - begin[a]:][:s]
                    for item, slots in table.get(_exact(w) if exact else "\x1f".join(x for x, _ in w), ()):
                        if exact or _consistent(slots, [x for _, x in w]):
                            mine = found.setdefault(n, {})
                            mine[item] = mine.get(item, 0) + 1
        for n in sorted(found):
            yield ids[n], found[n]


def item_windows(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(size, template, item_id, slots) of every window of every item."""
    def run(batches):
        for b in batches:
            rows = []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                w = template(t)
                size = min(WINDOW, len(w))
                if size:
                    rows += [{"size": size, "tpl": k, "item_id": i, "slots": [v for _, v in w[p:p + size]]}
                             for k, p in _windows(w, size)]
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("size", pa.int32()), ("tpl", pa.string()), ("item_id", pa.int64()), ("slots", pa.list_(pa.string()))]))
    return items.select(q(item_id).cast("long"), q(text).cast("string")).mapInArrow(
        run, "size int, tpl string, item_id long, slots array<string>").distinct()


#: Bytes of benchmark text up to which its windows are broadcast; beyond, rows meet by a shuffled join.
BROADCAST_BYTES = 16 << 20


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text",
            broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(doc_id, item_id, n_windows): every row and item with consistent windows in common."""
    doc_type = docs.schema[id_col].dataType.simpleString()
    wins = item_windows(items)
    src = docs.select(q(id_col).alias("doc_id"), q(text).cast("string").alias("text"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    if size <= broadcast_bytes:
        table: dict = {}
        for r in wins.collect():  # bounded by the check above
            table.setdefault(r["size"], {}).setdefault(r["tpl"], []).append((r["item_id"], r["slots"]))
        sent = docs.sparkSession.sparkContext.broadcast(table)

        def run(batches):
            known, words = _Known(sent.value), _Words()
            for b in batches:
                rows = []
                for i, found in known.met(words, zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
                    rows += [{"doc_id": i, "item_id": k, "n_windows": n} for k, n in found.items()]
                yield pa.RecordBatch.from_pylist(rows, pa.schema([("doc_id", b.schema.field(0).type), ("item_id", pa.int64()), ("n_windows", pa.int64())]))
        return src.mapInArrow(run, f"doc_id {doc_type}, item_id long, n_windows long")

    sizes = [r[0] for r in wins.select("size").distinct().collect()]  # at most WINDOW values
    # rows of one id and text count together and are told apart again at the end
    src = src.withColumn("th", F.xxhash64("text"))

    def cut(batches):
        seen: dict = {}
        for b in batches:
            for i, t, h in zip(*(b.column(c).to_pylist() for c in range(3))):
                w = template(t, seen)
                rows = [{"doc_id": i, "th": h, "size": s, "tpl": k, "vals": [v for _, v in w[p:p + s]]} for s in sizes for k, p in _windows(w, s)]
                yield pa.RecordBatch.from_pylist(rows, pa.schema([("doc_id", b.schema.field(0).type), ("th", pa.int64()), ("size", pa.int32()),
                                                                  ("tpl", pa.string()), ("vals", pa.list_(pa.string()))]))
    met = src.mapInArrow(cut, f"doc_id {doc_type}, th long, size int, tpl string, vals array<string>").join(wins, ["size", "tpl"])
    pair = F.arrays_zip("slots", "vals")
    one = F.size(F.array_distinct(pair))
    ok = (one == F.size(F.array_distinct("slots"))) & (one == F.size(F.array_distinct("vals")))
    found = met.where(ok).groupBy("doc_id", "th", "item_id").agg(F.count(F.lit(1)).alias("n"))
    times = src.groupBy(F.col("doc_id").alias("id"), F.col("th").alias("h")).agg(F.count(F.lit(1)).alias("times"))
    return (found.join(times, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("th") == F.col("h")))
            .select("doc_id", "item_id", (F.col("n") / F.col("times")).cast("long").alias("n_windows"),
                    F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("nth")).drop("nth"))


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the texts that match an item (a row goes with its id and text's hash)."""
    key = F.xxhash64(q("doc_id").cast("string"), q("text").cast("string"))
    keyed = docs.withColumn("__sl_key", key)
    bad = matches(keyed, items, id_col="__sl_key").select(F.col("doc_id").alias("__sl_key")).distinct()
    return keyed.join(bad, "__sl_key", "left_anti").select(*[q(c) for c in docs.columns])
