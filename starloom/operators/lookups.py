"""Key lookups between facts and dimensions.

A dimension's side is broadcast by ``broadcast_bounded`` after its row count
has been checked.  A larger one is shuffled and hashed, with AQE skew
splitting: its keys are unique, so that its rows spread evenly, while the fact's
need not (all its null keys meet in one task) and are streamed, never sorted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.dates import date_id


class DuplicateLookupKey(ValueError):
    """A map-style lookup found the same key twice on its lookup side."""


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


_ROWS_ATTR = "_starloom_rows"


def remember_rows(df: DataFrame, n: int | None) -> DataFrame:
    """Attach an exact row count known from an earlier job (for example the
    slice counts of a dense key), so a later size check needs no job."""
    if n is not None:
        setattr(df, _ROWS_ATTR, int(n))
    return df


def known_rows(df: DataFrame) -> int | None:
    return getattr(df, _ROWS_ATTR, None)


_TOP_ATTR = "_starloom_top"


def remember_top(df: DataFrame, top: int | None) -> DataFrame:
    """Attach the highest surrogate key of ``df``, known from the job that gave it."""
    if top is not None:
        setattr(df, _TOP_ATTR, int(top))
    return df


def known_top(df: DataFrame) -> int | None:
    return getattr(df, _TOP_ATTR, None)


_BYTES_ATTR = "_starloom_bytes"
#: Bytes of text that a broadcast side may hold beside its fixed-width columns.
MAX_TEXT_BYTES = 256 << 20


def remember_bytes(df: DataFrame, n: int | None) -> DataFrame:
    """Attach the bytes of text in the key columns of ``df``, known from an earlier job."""
    if n is not None:
        setattr(df, _BYTES_ATTR, int(n))
    return df


def known_bytes(df: DataFrame) -> int | None:
    return getattr(df, _BYTES_ATTR, None)


def _text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType.typeName() in ("string", "binary", "array", "map", "struct")]


def broadcast_bounded(df: DataFrame, max_rows: int = 100_000,
                      rows: int | None = None, text_bytes: int | None = None) -> DataFrame:
    """Broadcast ``df`` only when it has at most ``max_rows`` rows, and its
    text at most ``MAX_TEXT_BYTES``.

    ``rows`` and ``text_bytes`` (or what is remembered on ``df``) are used when
    known; otherwise one job reads at most ``max_rows + 1`` rows, so the check
    itself is bounded.  Above a bound the frame is returned unhinted.
    """
    return F.broadcast(df) if fits_broadcast(df, max_rows, rows, text_bytes) else df


def broadcast_or_hashed(df: DataFrame, max_rows: int = 100_000,
                        rows: int | None = None, text_bytes: int | None = None) -> DataFrame:
    """``broadcast_bounded``, and above a bound the side that a shuffled join
    hashes; for sides with one row a key."""
    return F.broadcast(df) if fits_broadcast(df, max_rows, rows, text_bytes) else df.hint("shuffle_hash")


def fits_broadcast(df: DataFrame, max_rows: int = 100_000, rows: int | None = None,
                   text_bytes: int | None = None) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows and ``MAX_TEXT_BYTES`` of
    text; reads at most ``max_rows + 1`` rows where either is not known."""
    n = rows if rows is not None else known_rows(df)
    size = text_bytes if text_bytes is not None else known_bytes(df)
    wide = _text_columns(df)
    if n is not None and n > max_rows:
        return False
    if n is None or (wide and size is None):
        text = F.sum(sum([F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in wide], F.lit(0)).cast("long"))
        n, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(text, F.lit(0))).first()
    return n <= max_rows and (not wide or size <= MAX_TEXT_BYTES)


DEFAULT_BROADCAST_ROWS = 1_000_000


def lookup_key(fact: DataFrame, dim: DataFrame, natural_key, key_name: str,
               how: str = "left", null_safe: bool = False,
               unknown: int | None = None,
               broadcast_max_rows: int | None = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Swap a natural key for the dimension's surrogate key.

    ``null_safe`` matches null with null (pandas merge behaviour);
    ``unknown`` replaces an unmatched key (0 = unknown member).
    The lookup side is only (natural key, surrogate key); it is broadcast when
    it has at most ``broadcast_max_rows`` rows, so the fact is not shuffled;
    above that both are shuffled, and the lookup side is hashed: a fact's rows
    of one key, say its null keys, take no memory for a sort.
    The natural-key column is kept; callers drop what they do not publish.
    """
    keys = _names(natural_key)
    right = dim.select(*[F.col(k).alias("__sl_r_" + k) for k in keys], F.col(key_name))
    if broadcast_max_rows and how in ("left", "inner", "left_semi", "left_anti"):
        right = broadcast_or_hashed(right, broadcast_max_rows, rows=known_rows(dim), text_bytes=known_bytes(dim))
    cond = None
    for k in keys:
        c = (F.col(k).eqNullSafe(F.col("__sl_r_" + k)) if null_safe
             else F.col(k) == F.col("__sl_r_" + k))
        cond = c if cond is None else cond & c
    out = fact.join(right, cond, how).drop(*["__sl_r_" + k for k in keys])
    if unknown is not None:
        out = out.withColumn(key_name, F.coalesce(F.col(key_name), F.lit(unknown)).cast("long"))
    return out


def date_key(fact: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Computed date keys (J5 default): ``{out_name: timestamp_column}``.

    No join: the key is a function of the value, so the date dimension never
    has to be shipped to the fact.
    """
    return fact.withColumns({out: date_id(src) for out, src in columns.items()})


def exact_date_key(fact: DataFrame, ts_col: str, lookup: DataFrame, out: str,
                   lookup_value: str = "date", lookup_id: str = "date_id",
                   check_unique: bool = True,
                   broadcast_max_rows: int | None = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """J5 literal: map a timestamp to an id by exact equality against ``lookup``.

    Like a pandas ``Series.map`` over an index, a duplicated lookup value is an
    error; a value absent from the lookup gives null (D2).
    """
    return exact_date_keys(fact, {out: ts_col}, lookup, lookup_value, lookup_id,
                           check_unique, broadcast_max_rows)


def exact_date_keys(fact: DataFrame, columns: dict[str, str], lookup: DataFrame,
                    lookup_value: str = "date", lookup_id: str = "date_id",
                    check_unique: bool = True,
                    broadcast_max_rows: int | None = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """``exact_date_key`` for several ``{out_name: timestamp_column}`` at once:
    the lookup side is checked for duplicates and sized for broadcast once,
    then joined once per column."""
    side = lookup.select(F.col(lookup_value).alias("__sl_v"), F.col(lookup_id).alias("__sl_id"))
    if check_unique:
        dup = side.groupBy("__sl_v").count().where("count > 1").limit(1).count()
        if dup:
            raise DuplicateLookupKey(f"lookup values in {lookup_value!r} are not unique")
    if broadcast_max_rows:
        side = broadcast_bounded(side, broadcast_max_rows)
    for out, ts_col in columns.items():
        fact = (fact.join(side, F.col(ts_col) == F.col("__sl_v"), "left")
                    .drop("__sl_v").withColumnRenamed("__sl_id", out))
    return fact
