"""States over time: validity intervals, sums as of given days, calendars without gaps, running sums.

Defined cases: an event without a day counts from the beginning; events of one day count together;
states of equal validity are added up before they meet any day; empty frames give empty results.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

# The days between which states without a beginning or an end hold.
BEGINNING, END = dt.date(1000, 1, 1), dt.date(9999, 12, 31)


def running_states(events: DataFrame, keys: list[str], day: str, value: str) -> DataFrame:
    """(keys, day, value): what the changes in `events` have added up to since each day with one."""
    daily = events.groupBy(*keys, F.coalesce(day, F.lit(BEGINNING)).alias(day)).agg(F.sum(value).alias(value))
    so_far = Window.partitionBy(*keys).orderBy(day).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.withColumn(value, F.sum(value).over(so_far))


def intervals(states: DataFrame, keys: list[str], day: str) -> DataFrame:
    """States (one per key and day) with the days on which they hold: valid_from up to, not including,
    valid_to, which is the day of the key's next state."""
    later = Window.partitionBy(*keys).orderBy("valid_from")
    dated = states.withColumn("valid_from", F.coalesce(day, F.lit(BEGINNING)))
    return dated.withColumn("valid_to", F.coalesce(F.lead("valid_from").over(later), F.lit(END))).drop(
        *([day] if day != "valid_from" else []))


def on_days(held: DataFrame, days: DataFrame) -> DataFrame:
    """Every row of `held` (valid_from, valid_to, ...) once for each of `days` (day) on which it holds.

    Intervals are cut at month borders, within the range asked for, and meet the days of their month
    only, so a task joins a month's share and never the whole history of a tenant.
    """
    first, last = days.agg(F.min("day"), F.max("day")).first()
    if first is None:
        return held.join(days, F.lit(False)).select(*held.columns, "day")
    begins, ends = F.greatest("valid_from", F.lit(first)), F.least(F.date_sub("valid_to", 1), F.lit(last))
    cut = held.where(begins <= ends).withColumn(
        "_month", F.explode(F.sequence(F.trunc(begins, "MM"), F.trunc(ends, "MM"), F.expr("interval 1 month"))))
    asked = days.select("day", F.trunc("day", "MM").alias("_month")).distinct()
    return cut.join(asked, "_month").where((F.col("valid_from") <= F.col("day")) & (F.col("day") < F.col("valid_to"))).drop("_month")


def month_end_days(df: DataFrame, date: str, as_of) -> DataFrame:
    """(day): the ends of all months from the first date of `df`, and `as_of` as the last one."""
    last = F.lit(as_of)
    first = df.where(F.col(date) <= last).agg(F.min(date).alias("first"))
    months = first.select(F.explode(F.sequence(
        F.trunc("first", "MM"), F.trunc(last, "MM"), F.expr("interval 1 month"))).alias("month"))
    return months.select(F.least(F.last_day("month"), last).alias("day"))


def every_period(daily: DataFrame, by: list[str], day: str, values: list[str], grain: str, last: Column, others: DataFrame) -> DataFrame:
    """`daily` with a row of zeros for each period (DAY or WEEK) without one, from a group's first to the
    later of its last one and `last`. Groups of `others` without any row have a row at `last`."""
    def start(date):
        return date if grain == "DAY" else F.trunc(date, grain)

    until = start(last)
    edges = daily.groupBy(*by).agg(F.min(day).alias("_first"), F.max(day).alias("_last"))
    edges = edges.join(others.select(*by).distinct(), by, "full").select(
        *by, F.coalesce("_first", until).alias("_first"), F.greatest("_last", until).alias("_last"))
    step = F.expr(f"interval 1 {grain.lower()}")
    calendar = edges.select(*by, F.explode(F.sequence(F.least("_first", "_last"), "_last", step)).alias(day))
    dense = calendar.join(daily, [*by, day], "left").unionByName(daily.where(F.col(day).isNull()))
    return dense.withColumns({v: F.coalesce(v, F.lit(0)) for v in values})


def running_sum(daily: DataFrame, by: list[str], day: str, value: str, name: str) -> DataFrame:
    """Adds `name`, the sum of `value` up to each day, undated rows first.

    In two levels: a running sum over a group's months, and one over the days of each month, so that no
    task sorts all days of a group.
    """
    month = F.trunc(day, "MM")
    before = Window.partitionBy(*by).orderBy("_month").rowsBetween(Window.unboundedPreceding, -1)
    months = daily.groupBy(*by, month.alias("_month")).agg(F.sum(value).alias("_sum"))
    carried = months.select(*(F.col(c).alias(f"_{c}") for c in by), F.col("_month").alias("_of"), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_carried"))
    same = reduce(Column.__and__, [*(F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by), F.col("_month").eqNullSafe(F.col("_of"))])
    inside = Window.partitionBy(*by, "_month").orderBy(day).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        daily.withColumn("_month", month).join(carried, same)
        .withColumn(name, F.col("_carried") + F.sum(value).over(inside))
        .drop("_month", "_of", "_carried", *(f"_{c}" for c in by)))
