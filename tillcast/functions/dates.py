"""Calendar arithmetic on DATE columns.

Weeks start on Monday. A week is identified by its Monday (``week_start``), so week
distances are exact across year ends; ``week_key`` is the ISO year-week, for display.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A Monday; day and week numbers count from here.
EPOCH_MONDAY = "1970-01-05"


def _epoch() -> Column:
    return F.lit(EPOCH_MONDAY).cast("date")


def week_start(day) -> Column:
    return F.trunc(day, "week")


def month_start(day) -> Column:
    return F.trunc(day, "month")


def week_key(day) -> Column:
    """ISO year and week as one integer, for example 201901 for 2018-12-31."""
    col = F.col(day) if isinstance(day, str) else day
    return (F.extract(F.lit("YEAROFWEEK"), col) * 100 + F.weekofyear(col)).cast("int")


def day_number(day) -> Column:
    return F.datediff(day, _epoch())


def week_number(day) -> Column:
    """Whole weeks since the epoch Monday; consecutive weeks differ by one."""
    return F.floor(day_number(day) / 7).cast("int")


def weeks_between(later, earlier) -> Column:
    return week_number(later) - week_number(earlier)


def _weekdays_before(day) -> Column:
    n = day_number(day)
    return F.floor(n / 7) * 5 + F.least(F.pmod(n, F.lit(7)), F.lit(5))


def business_days(start, end) -> Column:
    """Monday-to-Friday days in [start, end); negative over (end, start] when end < start."""
    forward = _weekdays_before(end) - _weekdays_before(start)
    backward = _weekdays_before(F.date_add(end, 1)) - _weekdays_before(F.date_add(start, 1))
    return F.when(F.col(end) < F.col(start), backward).otherwise(forward).cast("int")


def weekend_days(start, end) -> Column:
    """Days of [start, end) that are not business days."""
    return (F.datediff(end, start) - business_days(start, end)).cast("int")
