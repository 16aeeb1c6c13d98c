"""Connected components of an undirected graph by alternating large-star and small-star steps.

Each step is written to the shared folder, so the work of a round is never redone and a node with a
third of all edges is an ordinary skewed join that Spark splits at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _least(pairs: DataFrame) -> DataFrame:
    """Per node u of (u, v): the least of u and its v. Written, so that both join sides are shuffled plainly."""
    return written(pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "least")


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the least node of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (both.join(_least(both), "u").where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    met = down.join(_least(down), "u")
    return (met.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(met.select("u", F.col("m").alias("v"))).where("u <> v").distinct())


def components(edges: DataFrame) -> DataFrame:
    """(u, v): every node of `edges` that is not the least of its component, with that least node.

    Nodes are integers; the order is that of the integers; loops and repeated edges do no harm.
    """
    now = written(edges.where("u <> v").select("u", "v").distinct(), "edges")
    state = _state(now)
    while state[0]:
        now = written(_small_star(_large_star(now)), "edges")
        before, state = state, _state(now)
        if state == before:
            break
    return now
