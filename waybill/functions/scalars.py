"""Column helpers: ratios, boundary date differences, empty-aware strings.

All are compositions of built-in functions, so they stay inside code generation.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

WIDE = "decimal(24,4)"
UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def as_ts(value: Column | str | datetime) -> Column:
    """Timestamp column from a column, a literal datetime or its text form."""
    if isinstance(value, Column):
        return value
    return F.to_timestamp(F.lit(value if isinstance(value, str) else value.isoformat(sep=" ")))


def ratio(num: Column, den: Column, scale: int = 2, factor: int = 1) -> Column:
    """``factor * num / den`` as a decimal rounded half up; null when ``den`` is null or zero."""
    quotient = F.try_divide(num.cast(WIDE), den.cast(WIDE))
    return F.round(quotient * factor if factor != 1 else quotient, scale)


def pct(num: Column, den: Column, scale: int = 2) -> Column:
    """Percentage of ``num`` in ``den``, rounded."""
    return ratio(num, den, scale, factor=100)


def average(value: Column, scale: int = 2) -> Column:
    """Mean of the non-null values from an exact sum, rounded half up."""
    return ratio(F.sum(value), F.count(value), scale)


def pct_change(current: Column, previous: Column, scale: int = 2) -> Column:
    """Signed change from ``previous`` to ``current`` in percent."""
    return pct(current - previous, previous, scale)


def diff_boundary(unit: str, later: Column, earlier: Column) -> Column:
    """Number of unit boundaries crossed from ``earlier`` to ``later``.

    10:59 to 11:01 is one hour here, where an elapsed-time difference gives zero.
    """
    if unit == "day":
        return F.datediff(later, earlier).cast("bigint")
    step = UNIT_SECONDS[unit]

    def floored(c: Column) -> Column:
        return F.floor(F.unix_seconds(c.cast("timestamp")) / F.lit(step))

    return floored(later) - floored(earlier)


def bin_floor(ts: Column, seconds: int) -> Column:
    """Start of the fixed-width bin that holds ``ts`` (bins are aligned to the epoch)."""
    epoch = F.unix_seconds(ts.cast("timestamp"))
    return F.timestamp_seconds(epoch - F.pmod(epoch, F.lit(seconds)))


def week_start(ts: Column) -> Column:
    """Sunday that starts the week of ``ts``, as a date."""
    return F.date_sub(F.to_date(ts), F.dayofweek(ts) - 1)


def month_start(ts: Column) -> Column:
    return F.to_date(F.date_trunc("month", ts))


def day_of_week(ts: Column) -> Column:
    """0 for Sunday to 6 for Saturday."""
    return F.dayofweek(ts) - 1


def is_blank(c: Column) -> Column:
    return c.isNull() | (c == "")


def is_filled(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def first_filled(*cols: Column, default: str | None = "") -> Column:
    """First non-empty string; an empty string counts as missing."""
    tail = [] if default is None else [F.lit(default)]
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols], *tail)
