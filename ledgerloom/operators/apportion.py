"""Exact division of amounts into parts of whole cents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def cents(amount: Column) -> Column:
    return F.round(amount * 100, 0).cast("decimal(38,0)")


def apportioned(df: DataFrame, by: list[str], whole: str, part: str, name: str) -> DataFrame:
    """Adds `share`: the group's `whole` (in cents, the same in all its rows) divided in proportion to
    `part`, by largest remainder; of equal remainders the first `name` counts as larger.

    Shares of a group always add up to `whole`. Parts may be negative. A group of one row without a
    part, or whose parts add up to zero, cannot be divided: its first row by `name` becomes the whole's,
    without a name, and its other rows get nothing. A group's rows must differ in `name`.
    """
    group = Window.partitionBy(*by)
    named = group.orderBy(F.col(name).asc_nulls_first())
    df = df.withColumns({
        "_sum": F.coalesce(F.sum(part).over(group), F.lit(0)).cast("decimal(38,0)"),
        "_place": F.row_number().over(named)})
    scaled = (F.col(whole).cast("decimal(19,0)") * F.coalesce(F.col(part), F.lit(0)).cast("decimal(18,0)") * F.signum("_sum").cast("decimal(1,0)"))
    base = F.when(F.col("_sum") != 0, F.abs("_sum"))
    # decimal remainders keep the sign of the dividend; pmod makes them those of a floor
    df = df.withColumn("_scaled", scaled.cast("decimal(38,0)")).withColumn("_rest", F.pmod("_scaled", base.cast("decimal(38,0)")))
    df = df.withColumn("_floor", F.expr("(_scaled - _rest) div abs(_sum)").cast("decimal(38,0)"))
    df = df.withColumns({
        "_left": F.col(whole) - F.sum("_floor").over(group),
        "_order": F.row_number().over(group.orderBy(F.desc("_rest"), F.col(name).asc_nulls_first()))})
    share = F.when(F.col("_sum") != 0, F.col("_floor") + (F.col("_order") <= F.col("_left")).cast("int")).when(
        F.col("_place") == 1, F.col(whole)).otherwise(F.lit(0))
    divisible = F.when(F.col("_sum") != 0, F.col(name))
    return df.withColumn("share", share.cast("decimal(38,0)")).withColumn(name, divisible).drop(
        "_sum", "_place", "_scaled", "_rest", "_floor", "_left", "_order")
