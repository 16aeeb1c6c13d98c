"""Relationships of the star schema, many to one; every join carries the tenant.

Facts without a matching dimension row stay, with blank attributes, so totals remain whole.
Joins carry no hint: small dimensions are broadcast after Spark has checked their size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

DATE_COLUMNS = ("month_num", "quarter_name", "year_num")


def with_date(fact: DataFrame, dim_date: DataFrame, key: str = "txn_date_key",
              prefix: str = "") -> DataFrame:
    """Calendar attributes by a date key; `prefix` names a second role such as the due date."""
    days = dim_date.select(
        F.col("date_key").alias(key), *(F.col(c).alias(prefix + c) for c in DATE_COLUMNS))
    return fact.join(days, key, "left")


def with_dim(fact: DataFrame, dim: DataFrame, key: str, *attributes: str) -> DataFrame:
    return fact.join(dim.select("client_id", key, *attributes), ["client_id", key], "left")


def with_header(lines: DataFrame, header: DataFrame, key: str, *attributes: str) -> DataFrame:
    """Header attributes on lines; both sides are large and are shuffled on (tenant, key)."""
    return lines.join(header.select("client_id", key, *attributes), ["client_id", key], "left")
