"""Near-duplicates by SimHash with pigeonhole blocks.

A text's A-Z are lower-cased, its words are the runs of bytes other than white space, its features
are all shingles of `SHINGLE` words (the whole sequence if there are fewer), hashed with XXH64. A bit
of the fingerprint is 1 if more than half of the hashes have it.

Fingerprints within `MAX_BITS` bits of each other are linked. Of `BLOCKS` blocks of bits, a linked
pair has at least BLOCKS - MAX_BITS equal, so it meets in the bucket of some choice of that many
blocks. Work is on distinct fingerprints. A bucket yields links that join its members as its close
pairs do, fewer than it has members, never all pairs. A bucket over `BUCKET` members is cut into
parts by a salt and each two parts meet in a task of their own, so no task holds a whole bucket.

Defined cases: null and blank texts have fingerprint zero and are linked like any other; repeated
rows are kept; a component's id is its least known document id (null if none is known); an empty
frame gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from .common import written
from .components import components

SHINGLE = 4
SEED = 42
MAX_BITS = 4
BLOCKS = 7
BUCKET = 2048

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def shingle_hashes(text: str | None) -> np.ndarray:
    words = (text or "").encode().lower().split()  # on bytes: A-Z and the six ASCII spaces only
    joined = b" ".join(words)
    if len(words) < SHINGLE:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)] if words else [], dtype=np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[: len(words) - SHINGLE] + 1]).tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts, ends[SHINGLE - 1 :].tolist())),
        np.uint64, len(starts))


def fingerprint(text: str | None) -> int:
    """The fingerprint as a signed 64-bit integer."""
    hashes = shingle_hashes(text)
    if not len(hashes):
        return 0
    columns = np.ascontiguousarray(hashes.astype(">u8").view(np.uint8).reshape(-1, 8).T)
    counts = np.concatenate([np.bincount(c, minlength=256) @ _BITS for c in columns])
    return int(np.packbits(counts * 2 > len(hashes)).view(">i8")[0])


@F.pandas_udf(T.LongType())
def fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in batches:
        yield pd.Series([fingerprint(t) for t in batch], dtype="int64")


def masks() -> list[int]:
    """For each choice of blocks that must be equal: its bits, as a signed 64-bit integer."""
    cuts = [round(64 * i / BLOCKS) for i in range(BLOCKS + 1)]
    block = [sum(1 << b for b in range(a, z)) for a, z in zip(cuts, cuts[1:])]
    chosen = (sum(c) for c in itertools.combinations(block, BLOCKS - MAX_BITS))
    return [m - (1 << 64) if m >= 1 << 63 else m for m in chosen]


def spanning_links(members: np.ndarray) -> list[tuple[int, int]]:
    """Links (larger, smaller) that join `members` exactly as their pairs within MAX_BITS do."""
    members = np.unique(members)
    bits = members.view(np.uint64)
    left, links = np.arange(len(members)), []
    while len(left):
        # grow one component from its least member; each member is compared with the rest once
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            at, front = front[0], front[1:]
            near = np.bitwise_count(bits[left] ^ bits[at]) <= MAX_BITS
            links += [(int(members[j]), int(members[at])) for j in left[near]]
            front, left = np.concatenate([front, left[near]]), left[~near]
    return links


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("u", T.LongType()), T.StructField("v", T.LongType())])))
def _links(buckets: pd.Series) -> pd.Series:
    return buckets.map(lambda b: [{"u": u, "v": v} for u, v in spanning_links(np.asarray(b, dtype=np.int64))])


def links(prints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Links (u, v) between distinct fingerprints (column `fp`) with the components of all close pairs."""
    keyed = prints.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks()])).alias("choice", "part"))
    sizes = keyed.groupBy("choice", "part").count()
    large = written(sizes.where(F.col("count") > bucket), "large-buckets")
    small = keyed.join(large, ["choice", "part"], "left_anti")
    # two salts cut a large bucket into n parts; a member meets its own and every other part
    parts = F.ceil(2 * F.col("count") / bucket)
    salted = (
        keyed.join(large, ["choice", "part"])
        .withColumn("n", parts).withColumn("salt", F.pmod(F.xxhash64("fp"), F.col("n")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
        .withColumn("a", F.least("salt", "other")).withColumn("b", F.greatest("salt", "other")))
    groups = (
        small.groupBy("choice", "part").agg(F.collect_list("fp").alias("fps")).select("fps")
        .unionByName(salted.groupBy("choice", "part", "a", "b").agg(F.collect_list("fp").alias("fps")).select("fps")))
    return groups.where(F.size("fps") > 1).select(F.explode(_links("fps")).alias("e")).select("e.*")


def near_duplicates(docs: DataFrame, key: str, text: str, bucket: int = BUCKET) -> DataFrame:
    """Per row of `docs`: the key (as `doc_id`), its fingerprint `fp` (signed) and its component_id."""
    rows = written(docs.select(F.col(key).alias("doc_id"), fingerprints(F.col(text)).alias("fp")), "fingerprints")
    classes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "classes")
    roots = components(links(classes.select("fp"), bucket))  # fingerprint u belongs to fingerprint v
    rooted = classes.join(roots.withColumnRenamed("u", "fp"), "fp", "left")
    linked = roots.select(F.col("v").alias("fp")).distinct().withColumn("is_root", F.lit(True))
    grouped = (
        rooted.join(linked, "fp", "left").where("n > 1 OR v IS NOT NULL OR is_root")
        .select("fp", "least", F.coalesce("v", "fp").alias("root")))
    # few classes need more than their own document; sums by root come before the join
    named = written(grouped.groupBy("root").agg(F.min("least").alias("component_id")), "component-ids")
    labels = written(grouped.join(named, "root").select("fp", "component_id"), "labels")
    return (
        rows.join(labels.withColumn("labelled", F.lit(True)), "fp", "left")
        .select("doc_id", "fp", F.when(F.col("labelled"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))


def hexadecimal(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
