"""Typed Parquet warehouse of bucketed tables, with keyed upsert."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.merge import merge, without_stale
from ..operators.quality import coerce_columns, keep_last
from ..schemas import columns, primary_key
from ..session import scratch_path
from . import files

# Pull time of a stored row, kept beside the declared columns, and the folder it lies in.
VERSION, SLICE = "_version", "slice"
# The file of a table that a row belongs to: its folder and bucket.
SLOT = "_slot"
SLICES = 8   # folders of a table: an upsert rewrites those its batch touches
BUCKETS = 8  # files of a folder, and tasks that read the stored side of a merge; about a million rows of the whole table each

MERGE_SETTINGS = {
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # buckets by the first two columns of a longer key serve joins on the whole key
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def layout(table: str) -> str:
    return ", ".join(f"{name} {dtype}" for name, dtype in columns(table))


def conform(df: DataFrame, table: str) -> DataFrame:
    """Exactly the declared columns and types; missing columns are null."""
    return df.select(*(
        (F.col(name) if name in df.columns else F.lit(None)).cast(dtype).alias(name)
        for name, dtype in columns(table)
    ))


def _physical(table: str) -> str:
    return f"{layout(table)}, {VERSION} timestamp_ntz"


def _versioned(df: DataFrame, table: str, *more: str) -> DataFrame:
    """Declared columns, the row version and whatever else is named."""
    return df.select(
        *((F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c)
          for c, t in columns(table)),
        VERSION, *more,
    )


def typed_scan(df: DataFrame, table: str) -> DataFrame:
    """Casts a text copy of a table to its declared types."""
    return conform(coerce_columns(df, dict(columns(table))), table)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Writes a frame once to the shared folder and returns the scan of the copy, which cuts
    lineage, survives the loss of executors and still prunes columns."""
    path = scratch_path(df.sparkSession, label)
    df.write.options(**files.WRITTEN).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Warehouse:
    """Tables under one root folder. Also a model: `table(name, *columns)`.

    A table is Spark's own bucketed table over Parquet files: partitioned into folders by a hash of the
    first two key columns and, in each folder, bucketed by these columns, so documents and their lines
    meet in like buckets. In a merge the stored side is read bucket by bucket and never shuffled; only
    the batch is dealt to the buckets. The merged folders are staged beside the tables first and then
    replace the touched folders by dynamic partition overwrite. A load that fails before that leaves
    the table as it was; one that fails during it is made good by loading the same batch again, since
    an upsert repeated changes nothing. One load at a time may write a table; readers who need
    snapshots need a table format, which this is not.

    Counts of folders and buckets are fixed for a table and part of its path. Without a catalog that
    outlives the session, tables are registered anew from their folders.
    """

    def __init__(self, spark: SparkSession, root: str, slices: int = SLICES, buckets: int = BUCKETS):
        self.spark, self.root, self.slices, self.buckets = spark, root.rstrip("/"), slices, buckets
        for key, value in MERGE_SETTINGS.items():
            spark.conf.set(key, value)
        files.keep_open(spark)

    def path(self, table: str) -> str:
        return f"{self.root}/{table}/{self.slices}x{self.buckets}"

    def table(self, name: str, *wanted: str) -> DataFrame:
        """A typed table; absent tables are empty."""
        return self._stored(name).select(*(wanted or (c for c, _ in columns(name))))

    def replace(self, table: str, df: DataFrame) -> None:
        """Full replacement of a table."""
        rows = conform(df, table).withColumn(VERSION, F.lit(None).cast("timestamp_ntz"))
        keys = bucket_columns(table)
        (
            _versioned(self._dealt(table, rows), table, SLICE).write.mode("overwrite").options(**files.WRITTEN).option("partitionOverwriteMode", "static")
            .option("path", self.path(table)).partitionBy(SLICE).bucketBy(self.buckets, *keys).saveAsTable(self._name(table))
        )

    def upsert(
        self, table: str, batch: DataFrame, order: list[Column] | None = None,
        match: list[str] | None = None, version: Column | None = None,
    ) -> None:
        """Inserts new keys and overwrites matched ones; other rows stay.

        `match` names the columns whose values in the batch replace target rows (the primary key
        unless given); a prefix of the key replaces whole groups such as one report. With a
        `version`, rows older than what the table holds are ignored, so late data cannot undo
        newer data. The batch is dealt to the table's files, there reduced to its last row per key by
        `order`, and, if there is something to merge it with, written once to the shared folder.
        """
        key = primary_key(table)
        match = match or key
        if not set(bucket_columns(table)) <= set(match):
            raise ValueError(f"{table} is replaced by at least {bucket_columns(table)}")
        stamp = F.lit(None) if version is None else version
        batch = batch.withColumn(VERSION, stamp.cast("timestamp_ntz"))
        order = order or [
            F.col(c) for c, _ in columns(table) if c in batch.columns and c not in key]
        batch = self._dealt(table, batch)
        if order and key:
            batch = keep_last(batch, [SLOT, *key], order)
        batch = _versioned(batch, table, SLICE)
        if not self._registered(table):
            self._first(table, batch)
            return
        if self._stored(table).isEmpty():
            batch.write.insertInto(self._name(table), overwrite=True)
            return
        batch = materialize(batch, f"batch-{table}")
        touched = [r[0] for r in batch.select(SLICE).distinct().collect()]  # at most one per folder
        if not touched:
            return
        target = self._stored(table).where(F.col(SLICE).isin(touched))
        if version is not None and _overlaps(target, batch):
            batch = without_stale(target, batch, match, VERSION, bucket_columns(table))
        merged = materialize(merge(target, batch, match, bucket_columns(table)), f"merged-{table}")
        _versioned(self._dealt(table, merged), table, SLICE).write.insertInto(self._name(table), overwrite=True)

    def _first(self, table: str, batch: DataFrame) -> None:
        (
            batch.write.mode("overwrite").options(**files.WRITTEN).option("path", self.path(table))
            .partitionBy(SLICE).bucketBy(self.buckets, *bucket_columns(table)).saveAsTable(self._name(table))
        )

    def _dealt(self, table: str, rows: DataFrame) -> DataFrame:
        """Rows dealt by the file they belong to, so that each folder gets a file per bucket. Tasks of few
        rows are merged; there are at most as many as files."""
        slot = F.col(SLICE) * self.buckets + F.pmod(F.hash(*_bucket_keys(table)), F.lit(self.buckets))
        return rows.drop(SLICE).withColumn(SLICE, self._slice(table)).withColumn(SLOT, slot).repartition(SLOT)

    def _slice(self, table: str) -> Column:
        return F.pmod(F.xxhash64(*_bucket_keys(table)), F.lit(self.slices)).cast("int")

    def _name(self, table: str) -> str:
        return f"{table}_{hashlib.md5(self.path(table).encode()).hexdigest()}"

    def _registered(self, table: str) -> bool:
        """Whether the table exists; one left by an earlier session is registered from its folder."""
        name = self._name(table)
        if self.spark.catalog.tableExists(name):
            return True
        if not any(n.startswith(f"{SLICE}=") for n in files.children(self.spark, self.path(table))):
            return False
        self.spark.sql(
            f"CREATE TABLE {name} ({_physical(table)}, {SLICE} INT) USING parquet PARTITIONED BY ({SLICE}) "
            f"CLUSTERED BY ({', '.join(bucket_columns(table))}) INTO {self.buckets} BUCKETS LOCATION '{self.path(table)}'")
        self.spark.catalog.recoverPartitions(name)
        return True

    def _stored(self, table: str) -> DataFrame:
        """The physical table with the version of each row."""
        if not self._registered(table):
            return self.spark.createDataFrame([], f"{_physical(table)}, {SLICE} int")
        return self.spark.table(self._name(table))


def bucket_columns(table: str) -> list[str]:
    return primary_key(table)[:2]


def _bucket_keys(table: str) -> list[Column]:
    """The bucket columns in their stored types: equal keys of whatever type have one place."""
    types = dict(columns(table))
    return [F.col(c).cast(types[c]) for c in bucket_columns(table)]


def _overlaps(target: DataFrame, batch: DataFrame) -> bool:
    """Whether any stored row is newer than the oldest batch row; one-column scans spare the
    usual in-order load the per-key check."""
    newest, oldest = target.agg(F.max(VERSION)).first()[0], batch.agg(F.min(VERSION)).first()[0]
    return newest is not None and (oldest is None or newest > oldest)
