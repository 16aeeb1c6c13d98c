"""Unions and the keyed merge of a batch into a table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def union(parts: list[DataFrame]) -> DataFrame:
    """Union by name of one or more frames."""
    return reduce(DataFrame.unionByName, parts)


def same_key(left: DataFrame, right: DataFrame, key: list[str], known: tuple | list = ()) -> Column:
    """Null-safe equality of all key columns; plain equality of those that are `known` not to be null,
    by which Spark may join buckets."""
    return reduce(Column.__and__, (left[k] == right[k] if k in known else left[k].eqNullSafe(right[k]) for k in key))


def _apart(rows: DataFrame, known: list[str]) -> list[tuple[DataFrame, list[str]]]:
    """`rows` whose `known` columns hold no null, then the others if there are any, each with the
    columns that may be compared by plain equality."""
    if not known:
        return [(rows, [])]
    blank = reduce(Column.__or__, (F.col(k).isNull() for k in known))
    others = rows.where(blank)
    return [(rows.where(~blank), known)] + ([] if others.isEmpty() else [(others, [])])


def merge(target: DataFrame, batch: DataFrame, key: list[str], buckets: list[str] | None = None) -> DataFrame:
    """Target rows without a match, then all batch rows. `batch` holds a key at most once.

    `buckets` are key columns by which the target is bucketed: it then takes part without a shuffle.
    Batch rows in which one of them is null are compared apart.
    """
    kept = target
    for rows, known in _apart(batch.select(*key), list(buckets or [])):
        keys = rows.alias("batch_keys")
        kept = kept.join(keys, same_key(kept, keys, key, known), "left_anti")
    return kept.unionByName(batch.select(*target.columns))


def without_stale(target: DataFrame, batch: DataFrame, key: list[str], version: str, buckets: list[str] | None = None) -> DataFrame:
    """Batch rows whose key has no newer version in the target."""
    news = batch.groupBy(*key).agg(F.max(version).alias("_news"))
    for rows, known in _apart(news, list(buckets or [])):
        newer = same_key(target, rows, key, known) & (target[version] > rows["_news"])
        stale = target.join(rows, newer).select(*(rows[k] for k in key)).distinct()
        batch = batch.join(stale, same_key(batch, stale, key), "left_anti")
    return batch
