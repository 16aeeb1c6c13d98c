"""Calendar expressions. The reporting day `as_of` is always an explicit argument."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def day(as_of: dt.date | Column) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(as_of)


def date_key(date: Column) -> Column:
    """yyyymmdd as INT; null when undated."""
    return (F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)).cast("int")


def month(date: Column) -> Column:
    """First day of the month."""
    return F.trunc(date, "MM")


def week_of_year(date: Column) -> Column:
    """Monday-first week number 0-53; days before the first Monday are in week 0."""
    return F.floor((F.dayofyear(date) + 6 - F.weekday(date)) / 7).cast("int")


def to_date_window(date: Column, as_of, grain: str) -> Column:
    """Whether `date` lies between the start of the period of `as_of` and `as_of`.

    `grain` is MM, QUARTER or YEAR.
    """
    return date.between(F.trunc(day(as_of), grain), day(as_of))


def days_late(due: Column, as_of) -> Column:
    """Days from the due date to `as_of`; negative while not yet due."""
    return F.datediff(day(as_of), due)


def days_into_year(as_of) -> Column:
    """Days from January 1 to `as_of` (0 on January 1)."""
    return F.datediff(day(as_of), F.trunc(day(as_of), "YEAR"))
