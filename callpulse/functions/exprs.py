"""Null-safe arithmetic helpers (ANSI mode: no division errors)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ratio(num, den) -> Column:
    """``num / den`` as double; null when ``den`` is 0 or null."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def pct(part, whole) -> Column:
    """Percentage ``100 * part / whole``, 0 when ``whole`` is 0."""
    return F.coalesce(ratio(F.lit(100.0) * _c(part), whole), F.lit(0.0))


def nullif_zero(x) -> Column:
    """Count that is null when no row matched (pandas filtered group-by)."""
    return F.when(_c(x) > 0, _c(x))


def cap(x, limit: float) -> Column:
    """Upper bound that keeps nulls null (unlike ``least``)."""
    return F.when(_c(x) > F.lit(limit), F.lit(limit)).otherwise(_c(x))
