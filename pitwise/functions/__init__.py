"""Scalar helpers: time parsing, safe ratios, fixed values."""

from pitwise.functions import codes
from pitwise.functions.exprs import flag_sum, no_money, ratio
from pitwise.functions.time import (
    as_compact_day,
    as_instant,
    day_start,
    epoch_days,
    instant_literal,
    parse_instant_text,
)

__all__ = [
    "codes",
    "flag_sum",
    "no_money",
    "ratio",
    "as_compact_day",
    "as_instant",
    "day_start",
    "epoch_days",
    "instant_literal",
    "parse_instant_text",
]
