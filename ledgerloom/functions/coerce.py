"""Ingest-time coercion of text to typed columns; bad values become null, never errors."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The spellings accepted as true, and the number grammar.
TRUE_WORDS = ("true", "True")
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
INFINITY = r"^\s*([+-]?)(?i:inf|infinity)\s*$"


def to_flag(text: Column) -> Column:
    """true / True are true; everything else, null included, is false."""
    return F.coalesce(text.isin(*TRUE_WORDS), F.lit(False))


def to_float(text: Column) -> Column:
    """DOUBLE for plain or scientific numbers and infinities, else null."""
    number = F.when(text.rlike(NUMBER), F.trim(text).try_cast("double"))
    infinite = F.when(text.rlike(INFINITY), F.when(text.contains("-"), F.lit(float("-inf")))
                      .otherwise(F.lit(float("inf"))))
    return F.coalesce(number, infinite)


def to_decimal(text: Column, dtype: str) -> Column:
    """Exact DECIMAL for the same number grammar; out-of-range values become null."""
    return F.when(text.rlike(NUMBER), F.trim(text).try_cast(dtype))


def to_int(text: Column, dtype: str = "bigint") -> Column:
    """Integer for whole numbers ('7', '7.0', '7e2'); fractional or bad text becomes null."""
    number = F.when(text.rlike(NUMBER), F.trim(text))
    near = number.try_cast("double")  # tells a fraction, however small
    return F.when(near == F.floor(near), number.try_cast("decimal(38,6)").try_cast(dtype))


def to_date(text: Column) -> Column:
    """DATE from yyyy-MM-dd or an ISO date-time (its own calendar day), else null (2024-02-30
    and 2024 are null)."""
    return to_datetime(text).try_cast("date")


def to_datetime(text: Column) -> Column:
    """TIMESTAMP_NTZ from yyyy-MM-dd[T ]HH:mm[:ss[.f]] or a plain date, else null. A zone or
    offset is accepted and left out: the time stays the one on the sender's clock."""
    shape = r"^(\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?)?)(Z|[+-]\d{2}:?\d{2})?$"
    local = F.regexp_extract(text, shape, 1)
    return F.when(local != "", local.try_cast("timestamp_ntz"))


def coerce(text: Column, dtype: str) -> Column:
    """Coercion rule of a warehouse column type."""
    if dtype == "boolean":
        return to_flag(text)
    if dtype in ("double", "float"):
        return to_float(text).cast(dtype)
    if dtype.startswith("decimal"):
        return to_decimal(text, dtype)
    if dtype in ("int", "bigint"):
        return to_int(text, dtype)
    if dtype == "date":
        return to_date(text)
    if dtype in ("timestamp", "timestamp_ntz"):
        return to_datetime(text).cast(dtype)
    return text.try_cast(dtype)
