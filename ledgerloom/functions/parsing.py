"""JSON parsing that is evaluated once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

DAMAGED = "_damaged"


def with_parsed(df: DataFrame, name: str, text: Column | str, schema: str) -> DataFrame:
    """Adds `name`, the struct parsed from `text`; null or a non-null `_damaged` field marks
    text that is not valid JSON of the schema.

    The struct comes out of a one-element generator. Filters and field accesses above then refer
    to a generated column; over a plain projection the optimizer would push the parser into
    each filter and run it several times per row.
    """
    parsed = F.from_json(
        text, f"{schema}, {DAMAGED} string", {"columnNameOfCorruptRecord": DAMAGED})
    return df.select("*", F.explode(F.array(parsed)).alias(name))


def is_damaged(name: str) -> Column:
    return F.col(name).isNull() | F.col(f"{name}.{DAMAGED}").isNotNull()
