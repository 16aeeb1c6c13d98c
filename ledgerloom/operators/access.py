"""Row-level security: users see the tenants they are mapped to."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def visible_to(df: DataFrame, user_map: DataFrame, user: str) -> DataFrame:
    """Rows of the tenants mapped to `user`."""
    allowed = user_map.where(F.col("user_email") == user).select("client_id")
    return df.join(allowed, "client_id", "left_semi")
