"""Incremental refresh: new landed files of all tenants flow into archive and warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans import etl
from ..sources import archive, landing
from ..sources.warehouse import Warehouse


def landed_stream(spark: SparkSession, root: str, files_per_batch: int = 10_000) -> DataFrame:
    """Pieces of files that arrive under `<client>/<source>/<time>.json`."""
    files = (
        spark.readStream.format("text").option("lineSep", landing.SEPARATOR)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(f"{root.rstrip('/')}/*/*/*.json")
    )
    return landing.with_position(files)


def refresh(
    spark: SparkSession, landed: str, archived: str, warehouse_root: str, progress: str,
    files_per_batch: int = 10_000,
) -> StreamingQuery:
    """Processes all files not yet seen, then stops.

    Each micro-batch is archived under its own id, overwriting a failed attempt of the same
    batch, and upserted from there. The upsert is keyed and versioned by pull time, so a batch
    may run twice and files may arrive late or out of order without changing the result.
    """
    warehouse = Warehouse(spark, warehouse_root)

    def load(pieces: DataFrame, batch_id: int) -> None:
        raw = landing.records(landing.in_reading_order(pieces))
        path = f"{archived.rstrip('/')}/batch_id={batch_id}"
        archive.overwrite(raw, path)
        etl.load_all(archive.read(spark, path), warehouse, f"stream-{batch_id}")

    return (
        landed_stream(spark, landed, files_per_batch)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )

