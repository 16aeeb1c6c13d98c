"""Last writer wins as streaming state: which landed records are news, late or repeated.

The state of a key (tenant, source, record id) is the position of its newest record, a few numbers in
the state store, which is checkpointed in the shared folder. So a batch of any age is told apart without
reading what was loaded before, and its news can be merged without looking for newer rows. Keys are held
in slots by a hash: a trigger reads and writes each slot that it touches once, and judges the
slot's records together.

Defined cases: of several news of one key in a batch only the newest is `new`, the others are
`passed`; a record at the position of the newest one is `repeated` (a file that landed twice), one
before it is `late`. Records without an id cannot be newer than one another and are all `keyless`.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from ..sources import archive

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUTPUT = "client_id string, source_name string, id string, micros long, block long, pos long, item int, verdict string, record string"
COLUMNS = [c.split()[0] for c in OUTPUT.split(", ")]
JUDGED = Row(*COLUMNS)
POSITION = ["micros", "block", "pos", "item"]
LOWEST = -(1 << 31)  # of a missing number; before all others
SLOTS = 1 << 12  # of all keys together; fixed for a state once begun


class NewestRecord(StatefulProcessor):
    """Keeps the position of a key's newest record: the verdicts on one key, row by row."""

    def init(self, handle) -> None:
        self.newest = handle.getValueState("newest", "micros long, block long, pos long, item long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = self.newest.get()
        held = tuple(held) if held else None
        batch = list(rows)
        places = [tuple(LOWEST if r[c] is None else r[c] for c in POSITION) for r in batch]
        best = max(places if held is None else [held, *places])
        seen = {held}
        for row, place in zip(batch, places):
            if place in seen:
                verdict = "repeated"
            elif place == best:
                verdict = "new"
            else:
                verdict = "late" if held is not None and place < held else "passed"
            seen.add(place)
            yield JUDGED(*(row[c] for c in COLUMNS[:-2]), verdict, row["record"])
        if best != held:
            self.newest.update(best)

    def close(self) -> None:
        pass


class NewestRecords(StatefulProcessor):
    """Keeps the positions of the newest records of a slot's keys, with the verdicts of `NewestRecord` on each.
    Positions hold no null."""

    def init(self, handle) -> None:
        self.newest = handle.getValueState("newest", "keys array<string>, places binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True)
        keys, places = self.newest.get() or ([], b"")
        known = len(keys)
        places = np.concatenate([np.frombuffer(places, "int64").reshape(-1, len(POSITION)), batch[POSITION].to_numpy("int64")])
        names, keys = pd.factorize(np.concatenate([np.array(keys, object), batch["key"].to_numpy(object)]))  # known ones first
        order = np.lexsort(places.T[::-1])
        rank = np.empty(len(places), int)
        rank[order] = np.cumsum(np.r_[0, (places[order][1:] != places[order][:-1]).any(axis=1)])
        held = np.full(len(keys), -1)
        held[:known] = rank[:known]
        best = held.copy()
        np.maximum.at(best, names[known:], rank[known:])
        name, place = names[known:], rank[known:]
        again = pd.DataFrame({"name": name, "place": place}).duplicated().to_numpy()
        batch["verdict"] = np.select(
            [again | (place == held[name]), place == best[name], place < held[name]], ["repeated", "new", "late"], "passed")
        if (best != held).any():
            of_rank = np.empty((rank.max() + 1, len(POSITION)), "int64")
            of_rank[rank] = places
            self.newest.update((keys.tolist(), of_rank[best].tobytes()))
        yield batch[[*COLUMNS, "blank"]]

    def close(self) -> None:
        pass


def with_id(raw: DataFrame) -> DataFrame:
    """Raw records with their id and position in columns."""
    return raw.select(
        "client_id", "source_name", F.get_json_object("record", "$.Id").alias("id"),
        F.unix_micros(F.col("ord.ts").cast("timestamp")).alias("micros"), F.col("ord.block").alias("block"),
        F.col("ord.pos").alias("pos"), F.col("ord.item").alias("item"), "record")


def judged(raw: DataFrame) -> DataFrame:
    """Every record of a stream of raw records with its verdict."""
    rows = with_id(raw)
    missing = [F.col(c).isNull().cast("int") * (1 << n) for n, c in enumerate(POSITION)]
    key = F.to_json(F.array("client_id", "source_name", "id"))
    keyed = rows.where("id IS NOT NULL").select(
        F.pmod(F.xxhash64(key), F.lit(SLOTS)).alias("slot"), key.alias("key"), "client_id", "source_name", "id", *(F.coalesce(c, F.lit(LOWEST)).cast("long").alias(c) for c in POSITION),
        reduce(Column.__add__, missing).alias("blank"), "record",
    ).groupBy("slot").transformWithStateInPandas(
        statefulProcessor=NewestRecords(), outputStructType=f"{OUTPUT}, blank int", outputMode="Append", timeMode="None")
    known = {c: F.when(F.col("blank").bitwiseAND(1 << n) == 0, F.col(c)) for n, c in enumerate(POSITION)}
    keyed = keyed.withColumns(known).select(COLUMNS)
    return keyed.unionByName(rows.where("id IS NULL").withColumn("verdict", F.lit("keyless")))


def follow(spark: SparkSession, archived: str, out: str, progress: str) -> StreamingQuery:
    """Judges all records of an archive not yet seen, then stops. Each batch is written under its own
    id, so one that failed half way is repeated in place."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    raw = spark.readStream.schema(archive.LAYOUT).parquet(archived)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{out}/batch_id={batch_id}")

    return judged(raw).writeStream.foreachBatch(write).option("checkpointLocation", progress).trigger(availableNow=True).start()


def verdicts(spark: SparkSession, out: str) -> DataFrame:
    """All judged records, with the batch that brought them."""
    return spark.read.schema(f"{OUTPUT}, batch_id int").parquet(out)


def current(judged_rows: DataFrame) -> DataFrame:
    """The newest record of each key. News of one key come in growing batches, so the one of the last
    batch is the newest; keyless records all stay."""
    news = judged_rows.where("verdict = 'new'")
    last = news.groupBy("client_id", "source_name", "id").agg(F.max_by("record", "batch_id").alias("record"))
    return last.unionByName(judged_rows.where("verdict = 'keyless'").select("client_id", "source_name", "id", "record"))
