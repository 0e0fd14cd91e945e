"""Date expressions."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from tenura import fixed_values as fv

MICROS_PER_DAY = 86_400_000_000


def month_key(d: Column | str) -> Column:
    """202403 for any day of March 2024."""
    d = F.col(d) if isinstance(d, str) else d
    return F.year(d) * 100 + F.month(d)


def month_number(d: Column) -> Column:
    """Months since year 0: consecutive months differ by one."""
    return F.year(d) * 12 + F.month(d) - 1


def month_boundaries(start: Column, end: Column) -> Column:
    """Number of month boundaries between two dates."""
    return month_number(end) - month_number(start)


def whole_days(later: Column, earlier: Column) -> Column:
    """Elapsed whole days, floored: 23 hours back gives -1, not 0."""
    gap = F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))
    return F.floor(gap / MICROS_PER_DAY)


def parse_timestamp(c: Column) -> Column:
    """Timestamp from text; text that is no date becomes NULL instead of an error."""
    return F.try_to_timestamp(c)


def parse_day(c: Column) -> Column:
    return F.to_date(parse_timestamp(c))


def week_from_sunday(d: Column) -> Column:
    """Week of the year, weeks starting on Sunday, days before the first Sunday in week 0."""
    return F.floor((F.dayofyear(d) + 7 - F.dayofweek(d)) / 7).cast("int")


def weekday_from_monday(d: Column) -> Column:
    """Monday = 1 .. Sunday = 7."""
    return F.weekday(d) + 1


def first_of_month(d: date) -> date:
    return d.replace(day=1)


def calendar_months(first: date, last: date) -> list[date]:
    """Every month start from first to last."""
    months = [first_of_month(first)]
    while (nxt := first_of_month(months[-1] + timedelta(days=32))) <= last:
        months.append(nxt)
    return months


def month_spine(as_of: date, spine: str = "reference") -> list[date]:
    """Month starts covered by the monthly marts.

    ``reference`` steps 30 days at a time, one step per month since the start, so it
    skips February 2024 and falls behind later on; ``calendar`` lists every month.
    """
    first = fv.FIRST_DAY
    if spine == "calendar":
        return calendar_months(first, as_of)
    steps = (as_of.year - first.year) * 12 + as_of.month - first.month + 1
    hops = (first + timedelta(days=fv.SPINE_STEP_DAYS * i) for i in range(steps))
    return sorted({first_of_month(d) for d in hops})
