"""Period comparison on monthly series with gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def with_prior(
    series: DataFrame, by: list[str], value: str, months: int, prior: str = "prior"
) -> DataFrame:
    """Each month beside the value `months` earlier; an absent month is blank.

    The series is stacked on its shifted copy and regrouped, which is one shuffle and keeps
    months known only from the earlier period.
    """
    none = F.lit(None).cast(series.schema[value].dataType)
    shifted = series.select(
        *by, F.add_months("month", months).alias("month"), none.alias(value),
        F.col(value).alias(prior),
    )
    return (
        series.select(*by, "month", value, none.alias(prior))
        .unionByName(shifted)
        .groupBy(*by, "month")
        .agg(F.sum(value).alias(value), F.sum(prior).alias(prior))
    )
