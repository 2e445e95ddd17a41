"""Date and time helpers, all built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def parse_yyyymmdd(c: Column | str) -> Column:
    """``PARSE_DATE('%Y%m%d', CAST(c AS STRING))``. Bad input gives NULL
    (``try_to_date``) so that one bad row cannot fail a job; staging
    quarantines such rows instead."""
    col = F.col(c) if isinstance(c, str) else c
    return F.try_to_date(col.cast("string"), "yyyyMMdd")


def format_yyyymmdd(c: Column | str) -> Column:
    return F.date_format(c, "yyyyMMdd")


def month_start(c: Column | str) -> Column:
    """``DATE_TRUNC(d, MONTH)`` as a DATE (``trunc``, not ``date_trunc``,
    which returns a timestamp)."""
    return F.trunc(c, "MM")


def days_between(later: Column | str, earlier: Column | str) -> Column:
    """``DATE_DIFF(later, earlier, DAY)``: later - earlier in days."""
    return F.date_diff(later, earlier)


def floored_days_since(ts: Column | str, start: Column | str) -> Column:
    """Whole days elapsed from ``start`` (date or timestamp) to ``ts``,
    floored, so an hour before the start is day -1 (the pandas
    ``Timedelta.days`` rule)."""
    t = F.col(ts) if isinstance(ts, str) else ts
    s = F.col(start) if isinstance(start, str) else start
    delta = F.unix_micros(t.cast("timestamp")) - F.unix_micros(s.cast("timestamp"))
    return F.floor(delta / F.lit(MICROS_PER_DAY)).cast("int")


def event_time_from_micros(c: Column | str) -> Column:
    return F.timestamp_micros(c)
