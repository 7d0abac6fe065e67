"""Small column helpers shared by the operators (all built-in expressions)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(num: Column, den: Column) -> Column:
    """``num / den`` as double; null when the divisor is zero or null."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def flag_sum(cond: Column) -> Column:
    """Count of rows where ``cond`` holds, as double (null/false count 0)."""
    return F.sum(F.when(cond, F.lit(1.0)).otherwise(F.lit(0.0)))


def no_money() -> Column:
    """Zero as money."""
    return F.lit(0).cast("decimal(18,2)")


def not_equal_all(c: Column, values: Iterable) -> Column:
    """``c != v`` for every ``v``; null when ``c`` is null (as ``=!=`` does)."""
    cond = None
    for v in values:
        term = c != F.lit(v)
        cond = term if cond is None else (cond & term)
    return cond
