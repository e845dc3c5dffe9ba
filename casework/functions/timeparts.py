"""Calendar buckets and elapsed-time parts, as Spark Columns.

Spark and PostgreSQL disagree on several of these (week numbering, weekday
text, interval fields, date truncation types); each helper documents the
semantics it keeps.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def week_from_jan1(c: str | Column) -> Column:
    """Two-digit week number where week 1 starts on 1 January (``to_char(d,'WW')``).

    Not ISO ``weekofyear``: days 1-7 of the year are week 01, 8-14 week 02.
    """
    week = F.floor((F.dayofyear(_col(c)) - 1) / 7) + 1
    return F.lpad(week.cast("string"), 2, "0")


def weekday_name(c: str | Column) -> Column:
    """Lower-case full weekday name (``trim(to_char(ts, 'day'))``)."""
    return F.lower(F.date_format(_col(c), "EEEE"))


def hour_of_day(c: str | Column) -> Column:
    """``date_part('hour', ts)`` as bigint."""
    return F.hour(_col(c)).cast("bigint")


def elapsed_micros(start: str | Column, end: str | Column) -> Column:
    """Total microseconds from start to end (``date_part('epoch', end - start)`` * 1e6)."""
    return F.timestamp_diff("MICROSECOND", _col(start), _col(end))


def elapsed_minutes(start: str | Column, end: str | Column, scale: int = 2) -> Column:
    """Total minutes between two timestamps as an exact decimal, rounded half-up."""
    micros = elapsed_micros(start, end).cast("decimal(20,0)")
    return F.round(micros / F.lit(60_000_000).cast("decimal(20,0)"), scale)


def minute_field(start: str | Column, end: str | Column) -> Column:
    """The *minute field* of ``end - start`` (wraps at 60), not total minutes.

    ``date_part('minute', interval)``: an interval of 1 h 10 min gives 10.
    """
    return F.extract(F.lit("MINUTE"), _col(end) - _col(start)).cast("bigint")


def month_start(c: str | Column) -> Column:
    """First day of the month as a DATE (``date_trunc('month', d)::date``)."""
    return F.trunc(F.to_date(_col(c)), "month")


def days_between(start: str | Column, end: str | Column) -> Column:
    """Whole days ``end - start`` for dates (or timestamps cut to dates)."""
    return F.datediff(F.to_date(_col(end)), F.to_date(_col(start)))


def as_date(value: str | _dt.date) -> _dt.date:
    return value if isinstance(value, _dt.date) else _dt.date.fromisoformat(value)


def _ts_lit(d: _dt.date) -> Column:
    """Midnight of ``d`` as a zone-less timestamp literal (constant-folded)."""
    return F.lit(f"{d.isoformat()} 00:00:00").cast("timestamp_ntz")


def date_after(c: str | Column, bound: str | _dt.date, inclusive: bool = False) -> Column:
    """``to_date(c) > bound`` written as a range on ``c`` so Parquet can prune.

    For a timestamp column the test becomes ``c >= bound + 1 day``
    (or ``c >= bound`` when inclusive), which is pushed into the scan.
    """
    b = as_date(bound)
    start = b if inclusive else b + _dt.timedelta(days=1)
    return _col(c) >= _ts_lit(start)


def date_at_most(c: str | Column, bound: str | _dt.date) -> Column:
    """``to_date(c) <= bound`` as the prunable range ``c < bound + 1 day``."""
    end = as_date(bound) + _dt.timedelta(days=1)
    return _col(c) < _ts_lit(end)


def in_year(c: str | Column, year: int) -> Column:
    """``date_part('year', c) = year`` rewritten as a half-open range (prunable)."""
    return (_col(c) >= _ts_lit(_dt.date(year, 1, 1))) & (_col(c) < _ts_lit(_dt.date(year + 1, 1, 1)))


def day_bucket_label(days: str | Column, width: int = 30) -> Column:
    """Label a day count with its ``width``-day period: 0-30, 31-60, 61-90, ...

    Day 0 belongs to the first period, so period k (k >= 1) covers
    ``(k-1)*width+1 .. k*width`` and its label starts at 0 for k = 1.
    """
    d = _col(days)
    k = F.greatest(F.ceil(d / F.lit(width)).cast("bigint"), F.lit(1))
    lo = F.when(k == 1, F.lit(0)).otherwise((k - 1) * width + 1)
    return F.concat(lo.cast("string"), F.lit("-"), (k * width).cast("string"))
