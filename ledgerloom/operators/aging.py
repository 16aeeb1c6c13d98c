"""Aging of open balances by days past the due date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.blank import sum_if
from ..functions.dates import days_late

RECEIVABLE_EDGES = (30, 60, 90)
PAYABLE_EDGES = (30, 60)


def bucket_sums(as_of, edges: tuple[int, ...], due: str = "due_date") -> dict[str, Column]:
    """Named conditional sums: not due, one per edge, beyond the last edge, and undated."""
    late, balance = days_late(F.col(due), as_of), F.col("balance")
    sums = {"not_due": sum_if(late <= 0, balance)}
    low = 1
    for edge in edges:
        sums[f"days_{low}_{edge}"] = sum_if(late.between(low, edge), balance)
        low = edge + 1
    sums[f"over_{edges[-1]}"] = sum_if(late > edges[-1], balance)
    sums["undated"] = sum_if(F.col(due).isNull(), balance)
    return sums


def aging(df: DataFrame, by: list[str], as_of, edges: tuple[int, ...]) -> DataFrame:
    """Open balance per group, split into buckets in one pass; buckets add up to the total."""
    sums = bucket_sums(as_of, edges)
    return (
        df.where("balance > 0")
        .groupBy(*by)
        .agg(*(c.alias(n) for n, c in sums.items()), F.sum("balance").alias("total_open"))
    )
