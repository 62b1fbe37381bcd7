"""Column expressions: day arithmetic, ratios, text folding."""

from callpulse.functions.timefns import add_days, add_hours, floor_days, minutes_between, parse_utc, round_to_day
from callpulse.functions.exprs import cap, nullif_zero, pct, ratio

__all__ = [
    "add_days",
    "add_hours",
    "floor_days",
    "minutes_between",
    "parse_utc",
    "round_to_day",
    "cap",
    "nullif_zero",
    "pct",
    "ratio",
]
