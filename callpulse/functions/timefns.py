"""Day arithmetic on ``timestamp_ntz`` columns (UTC wall clock).

Day differences are floored 24-hour counts (-1 h gives -1), not calendar
day boundaries; rounding to the nearest day is half-to-even on epoch days.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_US_PER_DAY = 86_400_000_000


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def floor_days(a, b) -> Column:
    """Whole 24-hour periods from ``b`` to ``a``, floored (``(a - b).days``)."""
    us = F.timestamp_diff("MICROSECOND", _c(b), _c(a))
    return F.floor(us / F.lit(_US_PER_DAY)).cast("bigint")


def minutes_between(start, end) -> Column:
    """Whole minutes from ``start`` to ``end``, truncated toward zero."""
    return F.timestamp_diff("MINUTE", _c(start), _c(end))


def round_to_day(ts) -> Column:
    """Nearest midnight, ties to the even epoch day; stays ``timestamp_ntz``."""
    us = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), _c(ts))
    days = F.bround(us / F.lit(float(_US_PER_DAY)), 0).cast("int")
    return F.date_add(F.lit("1970-01-01").cast("date"), days).cast("timestamp_ntz")


def parse_utc(text) -> Column:
    """Text to UTC wall clock (``timestamp_ntz``); null where it is no date.

    A text without a zone is UTC already; the session's zone plays no part.
    """
    t = F.trim(_c(text))
    zoned = F.regexp_like(t, F.lit(r"(Z|[+-]\d{2}(:?\d{2})?|UTC|GMT)$")) & F.regexp_like(t, F.lit(r"\d:\d"))
    day = F.regexp_like(t, F.lit(r"^\d{4}-\d{1,2}-\d{1,2}$"))
    full = F.when(zoned, t).when(day, F.concat(t, F.lit(" 00:00:00Z"))).otherwise(F.concat(t, F.lit("Z")))
    us = F.unix_micros(full.try_cast("timestamp"))
    return F.timestamp_add("MICROSECOND", us, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def _q(n) -> Column:
    return F.lit(n) if isinstance(n, int) else _c(n).cast("int")


def add_days(ts, n) -> Column:
    """``ts`` plus ``n`` calendar days (null when ``n`` is null)."""
    return F.timestamp_add("DAY", _q(n), _c(ts))


def add_hours(ts, n) -> Column:
    return F.timestamp_add("HOUR", _q(n), _c(ts))
