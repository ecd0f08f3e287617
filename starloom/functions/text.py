"""Text functions (Column -> Column, JVM-side, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a word is a run of letters; everything else separates words.
# This is how Python's ``str.title`` splits ("d'oeste" -> "D'Oeste",
# "mogi-guacu" -> "Mogi-Guacu", "2a" -> "2A"), unlike ``initcap``, which
# splits on blanks only.
_LETTER_RUNS = r"(\p{L}+|[^\p{L}]+)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def title_case(c) -> Column:
    """Upper-case the first letter of every run of letters, lower the rest."""
    runs = F.regexp_extract_all(F.lower(_col(c)), F.lit(_LETTER_RUNS), 1)
    capped = F.transform(runs, lambda w: F.concat(F.upper(F.substring(w, 1, 1)),
                                                  F.substring(w, 2, 1 << 30)))
    return F.array_join(capped, "")


def upper_case(c) -> Column:
    return F.upper(_col(c))


def null_tokens(c, tokens) -> Column:
    """Turn any of ``tokens`` (e.g. ``["NA", "null"]``) into SQL NULL."""
    col = _col(c)
    if not tokens:
        return col
    return F.when(col.isin(list(tokens)), F.lit(None).cast("string")).otherwise(col)
