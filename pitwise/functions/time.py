"""Time handling: parse once at the edge, compare typed values after that.

Inputs may carry times as strings in dashed (``2020-05-01 10:00:00``) or
dotted (``2020.05.01 10:00:00``) form, as ``timestamp_ntz`` or as
``timestamp``. Everything is turned into ``timestamp`` (session zone) here,
so no feature ever compares times as text.
"""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MICROS_PER_DAY = 86_400_000_000

# Dotted dates are rewritten only in the date part, so fractional seconds
# ("10:00:00.5") keep their dot.
_DOTTED_DATE = r"^(\d{4})\.(\d{1,2})\.(\d{1,2})"


def parse_instant_text(c: Column) -> Column:
    """String time (dotted or dashed, optional fraction) -> timestamp or null."""
    dashed = F.regexp_replace(F.trim(c), _DOTTED_DATE, "$1-$2-$3")
    return F.try_to_timestamp(dashed)


def as_instant(df: DataFrame, name: str) -> Column:
    """Column ``name`` of ``df`` as a ``timestamp``, whatever its stored type."""
    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, T.StringType):
        return parse_instant_text(c)
    if isinstance(dtype, (T.TimestampType,)):
        return c
    if isinstance(dtype, (T.TimestampNTZType, T.DateType)):
        return c.cast("timestamp")
    raise TypeError(f"column {name!r} of type {dtype.simpleString()} is not a time")


def as_compact_day(df: DataFrame, name: str) -> Column:
    """``yyyyMMdd`` text or number (or any time type) -> ``date``."""
    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, T.IntegralType):
        return F.try_to_date(c.cast("string"), "yyyyMMdd")
    if isinstance(dtype, T.StringType):
        return F.try_to_date(F.trim(c), "yyyyMMdd")
    if isinstance(dtype, T.DateType):
        return c
    return as_instant(df, name).cast("date")


_GIVEN_DATE = re.compile(r"(\d{4})[.-](\d{1,2})[.-](\d{1,2})(?:[ T](.+))?")


def as_datetime(value: str | datetime | date) -> datetime:
    """A time given by the caller; raises ``ValueError`` if it is none.

    Text may be dashed or dotted and may have an offset; then, as with an
    aware ``datetime``, it names an instant. Without one it is a time of the
    session zone.
    """
    if isinstance(value, datetime):
        return value
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day)
    m = _GIVEN_DATE.fullmatch(str(value).strip())
    if not m:
        raise ValueError(f"not a time: {value!r}")
    day = f"{m[1]}-{int(m[2]):02d}-{int(m[3]):02d}"
    return datetime.fromisoformat(f"{day}T{m[4]}" if m[4] else day)


def instant_literal(value: str | datetime | date) -> Column:
    """A time given by the caller as a timestamp literal; see ``as_datetime``."""
    t = as_datetime(value)
    if t.tzinfo is not None:
        return F.timestamp_micros(F.lit((t - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)))
    return F.lit(t.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")


def scan_bound(df: DataFrame, name: str, before: str | datetime | date) -> Column | None:
    """A bound on the stored column that Parquet can use; it keeps every row before ``before``.

    Typed times are compared with a day to spare for zone differences; text,
    dashed or dotted, begins with the year, so it is compared with the next.
    """
    dtype = df.schema[name].dataType
    later = as_datetime(before) + timedelta(days=2)
    if isinstance(dtype, T.StringType):
        return F.col(name) < F.lit(f"{later.year + 1:04d}")
    if isinstance(dtype, T.TimestampNTZType):
        return F.col(name) < F.lit(later.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    if isinstance(dtype, T.TimestampType):
        return F.col(name) < instant_literal(before)
    if isinstance(dtype, T.DateType):
        return F.col(name) < F.lit(later.date().isoformat()).cast("date")
    return None


def epoch_days(ts: Column) -> Column:
    """Days since 1970-01-01 as a double (micro-second exact numerator)."""
    return F.unix_micros(ts) / F.lit(float(MICROS_PER_DAY))


def day_start(ts: Column) -> Column:
    """Midnight of the day of ``ts``."""
    return F.date_trunc("day", ts)


def trunc_period(ts: Column, period: str) -> Column:
    """Calendar period (``month``, ``day``, ...) an instant falls in."""
    return F.date_trunc(period, ts)
