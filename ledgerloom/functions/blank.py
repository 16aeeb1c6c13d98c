"""Arithmetic in which a missing total is blank (null) and blank counts as zero in sums."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def blank_add(a: Column, b: Column) -> Column:
    """a + b with a blank operand read as 0; blank only when both are."""
    return F.when(a.isNull() & b.isNull(), F.lit(None)).otherwise(
        F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))
    )


def blank_sub(a: Column, b: Column) -> Column:
    """a - b with a blank operand read as 0; blank only when both are."""
    return F.when(a.isNull() & b.isNull(), F.lit(None)).otherwise(
        F.coalesce(a, F.lit(0)) - F.coalesce(b, F.lit(0))
    )


def divide(a: Column, b: Column, alt: float | None = None, digits: int = 6) -> Column:
    """a / b as DOUBLE rounded to `digits`; `alt` where b is 0 or blank, blank where a is."""
    a, b = a.cast("double"), b.cast("double")
    ratio = F.when(b.isNotNull() & (b != 0), a / F.when(b != 0, b))
    return F.round(ratio.otherwise(F.lit(alt).cast("double")), digits)


def change(current: Column, prior: Column) -> Column:
    """Relative change against |prior|; blank when prior is blank or 0."""
    known = prior.isNotNull() & (prior != 0)
    delta = F.coalesce(current, F.lit(0)) - prior
    return F.when(known, divide(delta, F.abs(prior)))


def mean(total: Column, n: Column) -> Column:
    """Exact decimal mean rounded to cents."""
    return F.when(n > 0, F.round(total / F.when(n > 0, n), 2))


def sum_if(condition: Column, value: Column) -> Column:
    """Sum of `value` where `condition` is true; blank when no row qualifies."""
    return F.sum(F.when(condition, value))


def count_if(condition: Column) -> Column:
    """Number of rows where `condition` is true; blank (not 0) when there are none."""
    n = F.count(F.when(condition, F.lit(1)))
    return F.when(n > 0, n)


def distinct_with_null(value: Column) -> Column:
    """Distinct count in which null is one more value."""
    return F.countDistinct(value) + F.coalesce(
        F.max(F.when(value.isNull(), F.lit(1))), F.lit(0)
    )
