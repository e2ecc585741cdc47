"""Date functions. All take an explicit as-of date and ignore the session time zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_of_column(as_of: dt.date | str | Column | None = None) -> Column:
    """The reporting date: a date, ISO text, a column, or today when not given."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("date")


def _full_years(earlier: Column, later: Column) -> Column:
    def month_day(d: Column) -> Column:
        return F.month(d) * 100 + F.dayofmonth(d)

    not_reached = (month_day(later) < month_day(earlier)).cast("int")
    return F.year(later) - F.year(earlier) - not_reached


def completed_years(birth: Column, end: Column) -> Column:
    """Whole years from birth to end by calendar fields; truncates toward zero when negative.

    29 February is reached on 1 March in common years.
    """
    return F.when(end >= birth, _full_years(birth, end)).when(end < birth, -_full_years(end, birth))


def minutes_between(start: Column, stop: Column) -> Column:
    """Wall-clock minutes between two zone-less timestamps, as a double."""
    seconds = (stop - start).cast("interval second").cast("decimal(20,6)")
    return (seconds * 1_000_000).cast("bigint") / F.lit(60_000_000.0)


def days_since(as_of: Column, moment: Column) -> Column:
    """Calendar days from a timestamp's date to the as-of date."""
    return F.date_diff(as_of, moment.cast("date"))


def iso_text(day: Column) -> Column:
    """yyyy-MM-dd, for comparing with dates that are stored as text."""
    return F.date_format(day, "yyyy-MM-dd")
