"""What several operators share: reading a table, folds by document id, written intermediates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import scratch_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(key: Column, folds: int) -> Column:
    """crc32 of the id's decimal text modulo `folds`; null for a null id."""
    return F.crc32(key.cast("string").cast("binary")) % F.lit(folds)


def written(df: DataFrame, label: str) -> DataFrame:
    """`df` written once to the cluster's shared folder and read back, with its lineage cut."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def file_bytes(path: str) -> bytes:
    """A small model or vocabulary file, read where the driver runs."""
    with open(path, "rb") as file:
        return file.read()


def vocabulary_path(name: str) -> str:
    """Place of a vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


def hash_sample(df: DataFrame, by: Column, rows: int, total: int) -> DataFrame:
    """About `rows` of the `total` rows of `df`, chosen by the hash of `by` alone; equal ones stand or fall together."""
    share = min(1.0, rows / max(total, 1))
    return df.where(F.pmod(F.xxhash64(by), F.lit(1 << 30)) < int(share * (1 << 30)))


BROADCAST_ROWS = 1_000_000  # narrow rows (an id and a few numbers) that may be sent to every executor


def with_small(df: DataFrame, small: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """`df` joined with a narrow table: broadcast if its counted rows are few, else shuffled."""
    few = small.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return df.join(F.broadcast(small) if few else small, key, how)


def logistic(x, y, weight=None, ridge: float = 1e-3, prior=None, rounds: int = 50):
    """Coefficients of a logistic regression by Newton's method; the first column of x is the constant.

    `ridge` times the rows is the strength with which the coefficients are drawn to `prior` (0).
    """
    import numpy as np

    weight = np.ones(len(y)) if weight is None else weight
    prior = np.zeros(x.shape[1]) if prior is None else np.asarray(prior, dtype=float)
    beta, penalty = prior.copy(), np.full(x.shape[1], ridge * max(weight.sum(), 1))
    penalty[0] = 1e-9
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        curve = weight * p * (1 - p)
        step = np.linalg.solve((x * curve[:, None]).T @ x + np.diag(penalty + 1e-9), x.T @ (weight * (y - p)) - penalty * (beta - prior))
        size = np.abs(step).max()
        beta += step * min(1, 5 / max(size, 1e-12))
        if size < 1e-8:
            break
    return beta
