"""Exact top-k search by inner product with a vector-approximation file.

Every vector is stored in a block together with its approximation, one byte per component: the
component's cell on the block's own grid. For a block of queries and a block of candidates, the
cells are scanned first and give a lower and an upper bound of each inner product; exact vectors are
then read in the order of their upper bounds until the k-th best exact score is at least the next
upper bound. Only the k best of each block pair leave the task, so the result is exact.

Each block of queries meets each block of candidates through a slot number: a candidate block has
one slot, a query block is sent to every slot.

Components x become floor(1024 * x), computed in double precision. Vectors that are null or hold
null or non-finite components take no part, nor do rows without an id. Repeated rows count once; a
query never meets a vector of its own id; vectors of different lengths never meet; an empty vector
scores 0. Scores beyond the range of a long are held to it. Empty frames give empty results and
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from .common import written

SCALE = 1024
BLOCK = 2048        # vectors in a block, queries and candidates alike
LEVELS = 255        # cells per component
STEP = 32           # exact vectors read at a time
EXACT = 2.0 ** 53   # integers of this size are exact in a double
LONG = np.iinfo(np.int64)


def valid(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """Rows that take part, once each, with their components scaled and rounded down."""
    known = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return (
        vectors.select(F.col(key).alias("vec_id"), F.col(vector).cast("array<double>").alias("x"))
        .where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & F.forall("x", known))
        .dropDuplicates(["vec_id", "x"])
        .select("vec_id", F.transform("x", lambda x: F.floor(x * SCALE).cast("double")).alias("v")))


def approximate(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells of a block's vectors, and each component's cell width and origin."""
    low, high = matrix.min(axis=0), matrix.max(axis=0)
    width = np.maximum((high - low) / LEVELS, np.finfo(float).tiny)
    cells = np.clip(np.floor((matrix - low) / width), 0, LEVELS - 1).astype(np.uint8)
    # rounding may put a value just outside its cell; one more cell on both sides holds it surely
    return cells, width, low


def bounds(queries: np.ndarray, cells: np.ndarray, width: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the inner products, from the cells alone."""
    scaled = queries * width
    base = (queries @ low)[:, None]
    middle = base + scaled @ (cells.astype(float) + 0.5).T
    reach = 1.5 * np.abs(scaled).sum(axis=1)[:, None]
    reach = reach + 1e-9 * (np.abs(base) + np.abs(middle) + reach) + 1
    return middle - reach, middle + reach


def exact_scores(query: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Inner products as whole numbers."""
    if not matrix.size:
        return np.zeros(len(matrix), dtype=np.int64)
    if np.abs(query).max() * np.abs(matrix).max() * len(query) < EXACT:
        return np.rint(matrix @ query).astype(np.int64)
    whole = [int(x) for x in query]
    sums = [sum(a * int(b) for a, b in zip(whole, row)) for row in matrix]
    return np.array([min(max(s, LONG.min), LONG.max) for s in sums], dtype=np.int64)


def best_of(order: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best: higher score first, then smaller id."""
    best = np.lexsort((ids[order], ~scores))[:k]
    return order[best], scores[best]


def search_block(query_ids, queries, ids, matrix, cells, width, low, k) -> Iterator[tuple[int, int, int]]:
    """(query id, vector id, score) of each query's k best within a block."""
    lower, upper = bounds(queries, cells, width, low)
    for i, query_id in enumerate(query_ids):
        own = ids == query_id
        n = len(ids) - int(own.sum())
        if not n:
            continue
        up = np.where(own, -np.inf, upper[i])
        # fewer than k exceed the k-th largest lower bound, so nothing below it can be among the best
        floor = np.partition(np.where(own, -np.inf, lower[i]), -min(k, n))[-min(k, n)]
        order = np.flatnonzero((up >= floor) & ~own)
        order = order[np.argsort(-up[order], kind="stable")]
        read, scores = order[:0], np.zeros(0, dtype=np.int64)
        for at in range(0, len(order), STEP):
            if len(read) >= k and scores[k - 1] > up[order[at]]:
                break
            part = order[at : at + STEP]
            read, scores = best_of(
                np.concatenate([read, part]), np.concatenate([scores, exact_scores(queries[i], matrix[part])]), ids, k)
        for j, score in zip(read, scores):
            yield int(query_id), int(ids[j]), int(score)


def _blocks(rows: DataFrame, approximated: bool) -> DataFrame:
    """Rows packed into blocks of one vector length, each from rows of one partition."""
    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lengths = batch["v"].map(len)
            for dim, part in batch.groupby(lengths):
                for at in range(0, len(part), BLOCK):
                    some = part.iloc[at : at + BLOCK]
                    matrix = np.array(some["v"].tolist(), dtype=float).reshape(len(some), dim)
                    ids = some["vec_id"].to_numpy(np.int64).tobytes()
                    cells, width, low = approximate(matrix) if approximated else (np.zeros(0), np.zeros(0), np.zeros(0))
                    yield pd.DataFrame([(dim, ids, matrix.tobytes(), cells.tobytes(), width.tobytes(), low.tobytes())],
                                       columns=["dim", "ids", "matrix", "cells", "width", "low"])

    return rows.mapInPandas(packed, "dim int, ids binary, matrix binary, cells binary, width binary, low binary")


def top_k(vectors: DataFrame, key: str, vector: str, is_query, k: int = 10, slots: int | None = None) -> DataFrame:
    """For each vector of `vectors` for which `is_query` (a condition on `vec_id`) holds: its k best
    among all others, as query_id, rank (from 1), vec_id, score; ties go to the smaller id."""
    spark = vectors.sparkSession
    slots = slots or max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = written(valid(vectors, key, vector), "vectors")
    candidates = _blocks(rows, True).withColumn("slot", F.pmod(F.xxhash64("ids"), F.lit(slots)))
    queries = (
        _blocks(rows.where(is_query), False).select("dim", F.col("ids").alias("q_ids"), F.col("matrix").alias("q"))
        .withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slots - 1).cast("long")))))

    def searched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                query_ids, ids = (np.frombuffer(x, dtype=np.int64) for x in (r.q_ids, r.ids))
                found = list(search_block(
                    query_ids, np.frombuffer(r.q).reshape(len(query_ids), r.dim),
                    ids, np.frombuffer(r.matrix).reshape(len(ids), r.dim),
                    np.frombuffer(r.cells, dtype=np.uint8).reshape(len(ids), r.dim),
                    np.frombuffer(r.width), np.frombuffer(r.low), k))
                if found:
                    yield pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    pairs = candidates.join(queries, ["slot", "dim"]).drop("slot")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        pairs.mapInPandas(searched, "query_id long, vec_id long, score long")
        .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score"))
