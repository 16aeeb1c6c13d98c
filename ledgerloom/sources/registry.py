"""Tenant registry: a JSON array of client records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.coerce import to_date
from ..functions.parsing import is_damaged, with_parsed
from ..operators.ranking import top_n
from ..schemas import columns
from . import landing

LAYOUT = (
    "client_id string, client_name string, qbo_realm_id string, industry string, "
    "onboarded_date string, is_active boolean"
)


def read(spark: SparkSession, path: str) -> DataFrame:
    """dim_client from a registry file, active and inactive clients alike."""
    pieces = spark.read.option("lineSep", landing.SEPARATOR).text(path).select(
        F.lit("").alias("client_id"), F.lit("clients").alias("source_name"),
        F.struct(
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("pos"),
        ).alias("ord"),
        F.col("value").alias("piece"),
    )
    entries = with_parsed(landing.records(pieces), "r", "record", LAYOUT)
    return clients(entries.where(~is_damaged("r")).select("r.*", F.col("ord").alias("pos")))


def clients(entries: DataFrame) -> DataFrame:
    """Typed registry; the first entry of a client id wins, later ones are rejected."""
    first = top_n(entries.where("client_id is not null"), ["client_id"], [F.col("pos")], 1)
    typed = first.withColumns({
        "qbo_realm_id": F.coalesce("qbo_realm_id", F.lit("pending")),
        "onboarded_date": to_date(F.col("onboarded_date")),
        "is_active": F.coalesce("is_active", F.lit(True)),
    })
    return typed.select(*(name for name, _ in columns("dim_client")))
