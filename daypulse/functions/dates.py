"""Date helpers as Column expressions: midpoints, report periods, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def midpoint(start: Column | str, end: Column | str) -> Column:
    """Day halfway between two dates: ordinal ``(start + end) // 2`` (for end >= start)."""
    start, end = _c(start), _c(end)
    return F.date_add(start, F.floor(F.datediff(end, start) / 2).cast("int"))


def week_start(d: Column | str) -> Column:
    """Monday of the week holding ``d``."""
    return F.date_trunc("week", _c(d)).cast("date")


def previous_week(d: Column | str) -> tuple[Column, Column]:
    """Monday..Sunday of the week before the one holding ``d``."""
    monday = week_start(d)
    return F.date_sub(monday, 7), F.date_sub(monday, 1)


def previous_month(d: Column | str) -> tuple[Column, Column]:
    """First..last day of the calendar month before ``d`` (January -> December)."""
    first = F.trunc(_c(d), "month")
    start = F.add_months(first, -1)
    return start, F.last_day(start)


def period_bounds(day: Column | str, period_type: str) -> tuple[Column, Column]:
    """The report period (``weekly`` Mon-Sun or ``monthly``) that holds ``day``."""
    day = _c(day)
    if period_type == "weekly":
        s = week_start(day)
        return s, F.date_add(s, 6)
    if period_type == "monthly":
        return F.trunc(day, "month"), F.last_day(day)
    raise ValueError(f"unknown period type {period_type!r}")


# Display formats for dates.
DAY_LABEL = "EEE M/d"          # "Mon 1/5"
SHORT_DATE = "MMM dd"          # "Jan 05"
LONG_DATE = "MMM dd, yyyy"     # "Jan 05, 2025"
MONTH_DAY = "MMMM dd"          # "January 05"
WEEKDAY_DATE = "EEEE, MMM dd"  # "Monday, Jan 05"


def day_label(d: Column | str) -> Column:
    return F.date_format(_c(d), DAY_LABEL)
