"""Typing, keep-last deduplication and date keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.coerce import coerce
from ..functions.dates import date_key


def coerce_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Coerces text columns to the given types; columns not in the frame are skipped."""
    texts = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    return df.select(*(
        coerce(F.col(c), types[c]).alias(c)
        if c in types and c in texts and types[c] != "string" else F.col(c)
        for c in df.columns
    ))


def keep_last(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The last row of each key by `order`; null keys equal each other; no keys, no change.

    The rank filter turns into a map-side group limit: each input partition sends one row per
    key to the shuffle, so a very frequent key never gathers in one task.
    """
    if not keys:
        return df
    last = Window.partitionBy(*keys).orderBy(*(c.desc() for c in order))
    return df.withColumn("_rank", F.row_number().over(last)).where("_rank = 1").drop("_rank")


def add_date_key(df: DataFrame, date: str, key: str) -> DataFrame:
    """yyyymmdd of a date column; null where undated or where the column is missing."""
    if date not in df.columns:
        return df.withColumn(key, F.lit(None).cast("int"))
    return df.withColumn(key, date_key(F.col(date).try_cast("date")))


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
