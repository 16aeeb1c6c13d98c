"""Folders of any file system that Spark can reach."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    system, place = _located(spark, path)
    if not system.exists(place):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(place))


# Files that a writing task holds open, one per folder of its rows; with more folders it sorts its rows first.
OPEN_FILES = 16
# Written once, read a few times: denser files, and small row groups, of which an open file holds one in memory.
WRITTEN = {"compression": "zstd", "parquet.block.size": str(32 << 20)}


def keep_open(spark: SparkSession) -> None:
    """Rows go straight to the files of their folders, without a sort by folder that would spill."""
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", str(OPEN_FILES))


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _located(spark, path)
    return system.exists(place)
