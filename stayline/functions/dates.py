"""Date and time helpers with calendar-boundary semantics.

The reference's DATEDIFF(unit, a, b) counts unit *boundaries* crossed
between a and b, not elapsed whole units. Spark's ``datediff(end, start)``
already counts day boundaries; for hours and minutes both sides are
truncated first; for years the year numbers are subtracted.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def day_diff(start, end) -> Column:
    """Day boundaries from ``start`` to ``end`` (dates or timestamps)."""
    return F.datediff(F.to_date(_c(end)), F.to_date(_c(start)))


def hour_diff(start, end) -> Column:
    """Hour boundaries crossed: 15:50 -> 16:05 is 1."""
    a, b = F.date_trunc("HOUR", _c(start)), F.date_trunc("HOUR", _c(end))
    return F.timestamp_diff("HOUR", a, b)


def minute_diff(start, end) -> Column:
    """Minute boundaries crossed."""
    a, b = F.date_trunc("MINUTE", _c(start)), F.date_trunc("MINUTE", _c(end))
    return F.timestamp_diff("MINUTE", a, b)


def year_diff(start, end) -> Column:
    """Year numbers subtracted (boundary count), not whole years elapsed."""
    return F.year(_c(end)) - F.year(_c(start))


def month_day(d) -> Column:
    """Zero-padded 'MM-dd' text; compares in calendar order within a year."""
    return F.date_format(_c(d), "MM-dd")


def age_years(birth, on) -> Column:
    """Age on a date: year difference minus one if the birthday (by MM-dd)
    has not been reached yet. A 29 Feb birthday counts as reached on 1 Mar."""
    on_d = F.to_date(_c(on))
    b = F.to_date(_c(birth))
    return (year_diff(b, on_d)
            - F.when(month_day(on_d) < month_day(b), F.lit(1)).otherwise(F.lit(0))).cast("int")


def plus_days_keep_time(ts, n: int) -> Column:
    """Add whole days to a timestamp and keep the time of day."""
    return _c(ts) + F.make_dt_interval(F.lit(n))


def day_number(x) -> Column:
    """Days since 1970-01-01 of a date or timestamp (its calendar day)."""
    return F.unix_date(F.to_date(_c(x)))


def midnight_days_before(ts, n: int, like_type: str) -> Column:
    """Midnight of the calendar day ``n`` days before ``ts``, as ``like_type``."""
    return F.date_sub(F.to_date(_c(ts)), n).cast(like_type)
