"""Calendar functions used by the date dimension and the facts.

All of them take ``timestamp``, ``timestamp_ntz`` or ``date`` columns and stay
inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_id(c) -> Column:
    """Smart key yyyymmdd as int (20240301), null for null."""
    d = F.to_date(_col(c))
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def month_name(c) -> Column:
    """Full English month name ("March"); ``monthname`` gives "Mar"."""
    return F.date_format(_col(c), "MMMM")


def weekday_iso(c) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return (F.weekday(_col(c)) + 1).cast("int")


def weekday_name(c) -> Column:
    """Full English day name ("Friday"); ``dayname`` gives "Fri"."""
    return F.date_format(_col(c), "EEEE")


def is_weekend(c) -> Column:
    return F.weekday(_col(c)) >= 5


def floor_days(end, start) -> Column:
    """Whole days elapsed from ``start`` to ``end``, floored toward -inf.

    ``timestampdiff(DAY, ...)`` truncates toward zero and ``datediff`` counts
    calendar-day boundaries; neither floors a negative 1.25 days to -2.
    """
    micros = F.timestamp_diff("MICROSECOND", _col(start), _col(end))
    # in whole numbers: a double cannot hold the microseconds of far dates
    return F.call_function("div", micros - F.pmod(micros, F.lit(MICROS_PER_DAY).cast("long")),
                           F.lit(MICROS_PER_DAY).cast("long")).cast("int")


def calendar_columns(c) -> dict[str, Column]:
    """The descriptive columns of a date dimension row for ``c``."""
    d = _col(c)
    return {
        "year": F.year(d).cast("int"),
        "quarter": F.quarter(d).cast("int"),
        "month": F.month(d).cast("int"),
        "month_name": month_name(d),
        "day": F.dayofmonth(d).cast("int"),
        "weekday": weekday_iso(d),
        "weekday_name": weekday_name(d),
        "is_weekend": is_weekend(d),
    }
