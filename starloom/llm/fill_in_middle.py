"""Fill-in-the-middle transformation by secondary sort.

A text is cut into three runs of whole lines by two hashes of its id, and the
runs are put in another order, each behind its mark.  Texts travel in pieces:

1. a task walks each text once, in its own order, and emits chunks of whole
   lines (a line longer than ``CHUNK`` is cut) under the key (row, place in
   the output);
2. ``repartitionAndSortWithinPartitions`` brings the pieces of a row together
   in the order of the output, and an incremental digest takes them in one by
   one.  No text is held whole;
3. the pieces are read as the output they make: its marks are searched in the
   stream, and what stands between them goes on under the key (row, place in
   the text);
4. the second ``repartitionAndSortWithinPartitions`` has the partitioning of
   the first, so that it sorts inside the partitions without a shuffle, and a
   second digest takes in the restored text.

Both sorts spill; there are so many partitions that each gets ``PART_BYTES`` of
text (the session's number of shuffle partitions at least).  A row's key is a hash of its id, its text, its partition and
its number among equal rows there, so that copies spread over all partitions
and a task run again makes the same keys.

Defined results: null or empty text: no lines, plain, the digest of nothing;
texts that contain a mark are plain, whatever the hashes say; a null id counts
as the empty string in the hash; repeated rows give a row each; very long texts
and lines are cut into chunks; an empty table gives an empty result; other
columns of the input play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import q

MARKS = {"P": b"<P>", "S": b"<S>", "M": b"<M>"}
#: Order of the runs in the output, and in the text.
ORDERS = {"psm": "PSM", "spm": "SPM"}
TEXT_ORDER = "PMS"
#: Code points a piece holds at most.
CHUNK = 1 << 16
#: Bytes of text a partition of the sort is dealt.
PART_BYTES = 64 << 20


def lines(text: str) -> int:
    return text.count("\n") + (1 if text and not text.endswith("\n") else 0)


def after(text: str, n: int) -> int:
    """Where the text goes on after its first ``n`` lines."""
    at = 0
    for _ in range(n):
        at = text.find("\n", at) + 1
        if not at:
            return len(text)
    return at


def cut(doc_id, text: str, seed: int = 7, rate: int = 100, spm: int = 50) -> tuple[int, str, int, int]:
    """Lines, form, and where prefix and middle end (0 where plain)."""
    n = lines(text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i:8 * i + 8], 16) for i in range(4))
    if not text or any(m.decode() in text for m in MARKS.values()) or h3 % 100 >= rate:
        return n, "plain", 0, 0
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    first = after(text, low)
    return n, "spm" if h4 % 100 < spm else "psm", first, first + after(text[first:], high - low)


def chunks(text: str, lo: int, hi: int, most: int = CHUNK) -> Iterator[str]:
    """``text[lo:hi]`` in runs of whole lines, longer lines in parts."""
    while lo < hi:
        end = min(lo + most, hi)
        if end < hi:
            end = text.rfind("\n", lo, end) + 1 or end
        yield text[lo:end]
        lo = end


def pieces(doc_id, text: str, seed: int, rate: int, spm: int) -> Iterator[tuple[tuple[int, int], object]]:
    """A head under (-1, 0), then pieces of the output under (run, number),
    in the order of the text."""
    n, form, first, second = cut(doc_id, text, seed, rate, spm)
    plain = form == "plain"
    yield (-1, 0), (doc_id, n, form, None if plain else first, None if plain else second - first)
    if plain:
        for i, c in enumerate(chunks(text, 0, len(text))):
            yield (0, i), c.encode()
        return
    for run, lo, hi in (("P", 0, first), ("M", first, second), ("S", second, len(text))):
        mark = MARKS[run]
        rank = ORDERS[form].index(run)
        for i, c in enumerate(chunks(text, lo, hi)):
            yield (rank, i), mark + c.encode()
            mark = b""
        if mark:
            yield (rank, 0), mark


def restored(form: str, output: Iterator[bytes]) -> Iterator[tuple[int, bytes]]:
    """The stream of an output as (place of the run in the text, bytes)."""
    if form == "plain":
        yield from ((0, b) for b in output)
        return
    ahead, place, held = list(ORDERS[form]), 0, b""
    for b in output:
        held += b
        while ahead and (at := held.find(MARKS[ahead[0]])) >= 0:
            if at:
                yield place, held[:at]
            held = held[at + 3:]
            place = TEXT_ORDER.index(ahead.pop(0))
        keep = 2 if ahead else 0  # a mark may go on in the next piece
        if len(held) > keep:
            yield place, held[:len(held) - keep]
            held = held[len(held) - keep:]
    if held:
        yield place, held


def _by_row(records: Iterator) -> Iterator[tuple[bytes, object, Iterator[bytes]]]:
    """Sorted records as (row, head, its pieces one by one)."""
    got = next(records, None)
    while got is not None:
        (row, *_), head = got
        state = {"next": None}

        def rest():
            for r in records:
                if r[0][0] != row:
                    state["next"] = r
                    return
                yield r[1]
        inside = rest()
        yield row, head, inside
        for _ in inside:  # whatever was not asked for
            pass
        got = state["next"]


def transform(docs: DataFrame, id_col: str = "doc_id", text: str = "text", seed: int = 7, rate: int = 100,
              spm: int = 50, texts: bool = True, partitions: int | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n, form, prefix_chars, middle_chars,
    output_sha256, restored_sha256 and, with ``texts``, the output itself.

    ``rate`` of 100 texts are transformed, ``spm`` of 100 of those with the
    suffix first.
    """
    spark = docs.sparkSession
    src = docs.select(q(id_col).alias("doc_id"), q(text).cast("string").alias("text"))
    if partitions is None:
        size = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))

    def emit(part, rows):
        met: dict[bytes, int] = {}
        for doc_id, t in rows:
            t = t or ""
            same = hashlib.blake2b(repr(doc_id).encode() + b"\0" + t.encode(), digest_size=16).digest()
            nth = met[same] = met.get(same, -1) + 1
            row = hashlib.blake2b(same + b"%d,%d" % (part, nth), digest_size=16).digest()
            for place, piece in pieces(doc_id, t, seed, rate, spm):
                yield (row, *place), piece

    def put_out(records):
        for row, head, output in _by_row(records):
            digest, made = hashlib.sha256(), []

            def taken():
                for b in output:
                    digest.update(b)
                    if texts:
                        made.append(b)
                    yield b
            for i, (place, b) in enumerate(restored(head[2], taken())):
                yield (row, place, i), b
            yield (row, -1, 0), (*head, digest.hexdigest(), b"".join(made))

    def put_back(records):
        for _, head, text_ in _by_row(records):
            digest = hashlib.sha256()
            for b in text_:
                digest.update(b)
            *known, out, whole = head
            yield (*known, out, digest.hexdigest(), *([whole.decode()] if texts else []))

    def to(key):
        return int.from_bytes(key[0][:8], "big")

    sort = lambda rdd: rdd.repartitionAndSortWithinPartitions(partitions, to)
    out = sort(sort(src.rdd.mapPartitionsWithIndex(emit)).mapPartitions(put_out, preservesPartitioning=True))
    fields = [T.StructField("doc_id", src.schema["doc_id"].dataType), T.StructField("n", T.LongType()),
              T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
              T.StructField("middle_chars", T.LongType()), T.StructField("output_sha256", T.StringType()),
              T.StructField("restored_sha256", T.StringType())]
    if texts:
        fields.append(T.StructField("output", T.StringType()))
    return spark.createDataFrame(out.mapPartitions(put_back), T.StructType(fields), verifySchema=False)
