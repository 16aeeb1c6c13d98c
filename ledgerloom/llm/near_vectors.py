"""Near-duplicate vectors by an inverted multi-index.

Vectors of equal label (and length) are linked if their cosine, in double precision, is at least
`SIMILAR`. Each half of a vector has a codebook of its own, fitted on a bounded sample; the pair of
nearest codewords is the vector's cell in the product grid.

A linked partner may lie in another cell. How far a vector is from the border of a neighbouring cell
is known per half: the distance to the plane midway between its own codeword and the other one. The
two sorted lists of such distances are traversed together, nearest sum of squares first, up to the
reach at which `recall` of pairs at exactly the threshold would be found. The reach is measured on the
sample, against partners moved in all dimensions, in one half or in a few dimensions, and the largest
is taken; it does not depend on how many vectors there are. With recall 1 it is the distance of the threshold
itself, which no linked pair exceeds, so the search is exact.

A vector is sent to its own cell and to the cells it visits; in each cell all candidates are verified.
Candidates come in blocks: a cell with many vectors is cut into parts by a salt, and each part meets
each other part in a task's group of its own. Groups yield counts per vector and links that join
their members as the linked pairs do, never the pairs themselves. A pair that meets twice, since each
visits the other's cell, counts in one cell only.

Vectors of the same direction are one class, compared once and counted as often as they occur. That
takes the largest groups of copies; m different vectors near each other still take m * m / 2 inner
products, which are the result's own counts, spread over m * m / PART ** 2 groups.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components, and rows
without a label, link with nothing; a row that repeats id, label and direction counts once; rows of an
id that take no part give one row; a null id is linked like any other and names a component only if it has no
other id (then it is null and all its rows are kept); an empty frame gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import hash_sample, written
from .components import components

SIMILAR = 0.98
RECALL = 0.9999      # of pairs at the threshold
SAMPLE = 32_768      # vectors to which the codebooks are fitted, at most
SAMPLE_MB = 64       # and their size
TRIALS = 20_000      # vectors on which the reach is measured, per kind of partner
CELL = 256           # vectors of the largest label aimed at per cell
WORDS = 1024         # codewords per half, at most
PART = 2048          # vectors of a cell that one group holds
CHUNK = 1024         # rows worked on at a time, which bounds memory
EPSILON = 1e-9


# -- vectors ----------------------------------------------------------------------------------------

def units(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; first by their largest component, so that no square overflows."""
    scaled = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def linked(left: np.ndarray, right: np.ndarray, similar: float) -> np.ndarray:
    """Whether the cosine of each pair of unit rows reaches `similar`; sums too near it to tell are exact."""
    cosine = left @ right.T
    for i, j in zip(*np.nonzero(np.abs(cosine - similar) < 1e-13)):
        cosine[i, j] = math.fsum(left[i] * right[j])
    return cosine >= similar


def halves(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cut = matrix.shape[1] // 2
    return matrix[:, :cut], matrix[:, cut:]


# -- index ------------------------------------------------------------------------------------------

def squares(rows: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Squared distances up to a constant per row, the same for a row in whatever company it comes."""
    return (words * words).sum(axis=1) - 2 * np.einsum("ij,kj->ik", rows, words)


def nearest(rows: np.ndarray, words: np.ndarray) -> np.ndarray:
    lengths = (words * words).sum(axis=1)
    return np.concatenate([(lengths - 2 * (rows[at : at + CHUNK] @ words.T)).argmin(axis=1) for at in range(0, len(rows), CHUNK)])


def codebook(rows: np.ndarray, words: int, rounds: int = 12) -> np.ndarray:
    """Codewords of one half by k-means, begun at evenly spaced rows of the sorted sample."""
    if not rows.shape[1]:
        return np.zeros((1, 0))
    rows = np.unique(rows, axis=0)
    if len(rows) <= words:
        return rows
    found = rows[np.linspace(0, len(rows) - 1, words).astype(int)].copy()
    for _ in range(rounds):
        own = nearest(rows, found)
        counts, sums = np.bincount(own, minlength=words), np.zeros_like(found)
        np.add.at(sums, own, rows)
        found[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return np.unique(found, axis=0)


class Grid:
    """The product grid of two codebooks for vectors of one length."""

    def __init__(self, sample: np.ndarray, words: int, similar: float, recall: float):
        self.books = [codebook(h, words) for h in halves(sample)]
        self.apart = [np.sqrt(np.maximum(squares(b, b) + (b * b).sum(axis=1)[:, None], 0)) for b in self.books]
        self.similar = similar
        self.reach = self.measured(sample, recall)

    def gaps(self, matrix: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per half: each row's codeword, and a lower bound of its distance to the cell of each codeword."""
        out = []
        for half, book, apart in zip(halves(matrix), self.books, self.apart):
            far = squares(half, book)
            own = far.argmin(axis=1)
            between = apart[own]
            gap = (far - far[np.arange(len(half)), own][:, None]) / (2 * np.where(between > 0, between, 1))
            out.append((own, np.maximum(gap, 0)))
        return out

    def measured(self, sample: np.ndarray, recall: float) -> float:
        """The squared reach at which `recall` of partners at the threshold lie in a visited cell."""
        limit = 2 - 2 * self.similar + EPSILON
        if recall >= 1 or not len(sample) or sample.shape[1] < 2:
            return limit
        pick, dim = np.random.default_rng(len(sample)), sample.shape[1]
        rows = sample[pick.integers(0, len(sample), TRIALS)]
        away = math.sqrt(1 - self.similar ** 2)
        kinds = [np.ones((1, dim)), np.arange(dim)[None] < dim // 2, np.arange(dim)[None] >= dim // 2,
                 pick.random((TRIALS, dim)) < max(4 / dim, 0.05)]
        reach = 0.0
        for kind in kinds:
            noise = pick.normal(size=rows.shape) * kind
            noise -= (noise * rows).sum(axis=1, keepdims=True) * rows
            size = np.sqrt((noise * noise).sum(axis=1, keepdims=True))
            near = self.similar * rows + away * noise / np.where(size > 0, size, 1)
            gaps = [np.minimum(self.between(rows[at : at + CHUNK], near[at : at + CHUNK]), self.between(near[at : at + CHUNK], rows[at : at + CHUNK]))
                    for at in range(0, TRIALS, CHUNK)]
            reach = max(reach, float(np.quantile(np.concatenate(gaps), recall)))
        return min(reach * (1 + EPSILON) + EPSILON, limit)

    def between(self, rows: np.ndarray, others: np.ndarray) -> np.ndarray:
        """Squared distance of each row to the cell of the other row in the same place."""
        place = np.arange(len(rows))
        return sum(gap[place, own] ** 2 for (_, gap), (own, _) in zip(self.gaps(rows), self.gaps(others)))

    def visits(self, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each row's own cell, and (row, cell) of the other cells it visits.

        Multi-sequence traversal: codewords of each half in order of their distance; a row goes on in the
        first half as long as the sum with the nearest untried codeword of the second is within reach.
        """
        (own1, gap1), (own2, gap2) = self.gaps(matrix)
        width = len(self.books[1])
        home = own1 * width + own2
        order1, order2 = np.argsort(gap1, axis=1, kind="stable"), np.argsort(gap2, axis=1, kind="stable")
        place = np.arange(len(matrix))
        rows, cells = [], []
        ahead = place
        for i in range(gap1.shape[1]):
            one = order1[ahead, i]
            left = self.reach - gap1[ahead, one] ** 2
            ahead, one, left = ahead[left >= 0], one[left >= 0], left[left >= 0]
            if not len(ahead):
                break
            going, g_one, g_left = ahead, one, left
            for j in range(gap2.shape[1]):
                two = order2[going, j]
                ok = gap2[going, two] ** 2 <= g_left
                going, g_one, g_left = going[ok], g_one[ok], g_left[ok]
                if not len(going):
                    break
                rows.append(going)
                cells.append(g_one * width + two[ok])
        if not rows:
            return home, place[:0], home[:0]
        row, cell = np.concatenate(rows), np.concatenate(cells)
        other = cell != home[row]
        return home, row[other], cell[other]

    def visited(self, matrix: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """Whether each row of `matrix` visits each of `cells`."""
        (_, gap1), (_, gap2) = self.gaps(matrix)
        width = len(self.books[1])
        return gap1[:, cells // width] ** 2 + gap2[:, cells % width] ** 2 <= self.reach


# -- verification -----------------------------------------------------------------------------------

def joined(size: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The least member of each node's component, for the edges (left, right)."""
    root = np.arange(size)
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, root[left], low)
        np.minimum.at(new, root[right], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def verified(grid: Grid, target: int, ids, homes, weights, matrix, sides, inner: bool):
    """Counts and joining links of one group: rows of side 0 and 1 of the cell `target`, or, if
    `inner`, all rows against each other. Returns (id, other id or -1, count) rows."""
    first, second = (np.arange(len(ids)),) * 2 if inner else (np.flatnonzero(sides == 0), np.flatnonzero(sides == 1))
    if not len(first) or not len(second):
        return []
    hit = linked(matrix[first], matrix[second], grid.similar)
    if inner:
        hit &= first[:, None] < second[None]
    else:
        # of two that visit each other's cell, the one from the lower cell stays at home
        guests = np.flatnonzero((homes[first] != target) & hit.any(axis=1))
        if len(guests):
            cells, of = np.unique(homes[first[guests]], return_inverse=True)
            hosts = np.flatnonzero(hit[guests].any(axis=0))
            back = grid.visited(matrix[second[hosts]], cells)
            lower = (homes[first[guests]] < target)[:, None]
            block = hit[np.ix_(guests, hosts)] & ~(lower & back[:, of].T)
            hit[guests] = False
            hit[np.ix_(guests, hosts)] = block
    at, to = np.nonzero(hit)
    if not len(at):
        return []
    counts = np.zeros(len(ids), dtype=np.int64)
    np.add.at(counts, first[at], weights[second[to]])
    np.add.at(counts, second[to], weights[first[at]])
    root = joined(len(ids), first[at], second[to])
    met = np.flatnonzero(counts)
    out = [(int(ids[i]), -1, int(counts[i])) for i in met]
    return out + [(int(ids[i]), int(ids[root[i]]), 0) for i in met if root[i] != i]


def near_pairs(classes: DataFrame, grids: dict, part: int = PART) -> DataFrame:
    """(class, other, links) of the linked classes: counts (other null) and links that join them.

    `classes`: class, label, dim, x (bytes), n.
    """
    shared = classes.sparkSession.sparkContext.broadcast(grids)

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, same in batch.groupby("dim"):
                for at in range(0, len(same), CHUNK):
                    rows = same.iloc[at : at + CHUNK]
                    home, row, cell = shared.value[dim].visits(units(unpacked(rows["x"], dim)))
                    every = np.concatenate([np.arange(len(rows)), row])
                    yield rows.iloc[every].assign(home=home[every], cell=np.concatenate([home, cell]))

    # the index is computed twice, to size the cells and to deal the vectors: cheaper than writing it with vectors
    schema = "class long, label string, dim int, x binary, n long"
    index = classes.select("class", "label", "dim", "x", "n").mapInPandas(placed, f"{schema}, home long, cell long")
    key = ["label", "dim", "cell"]
    hosts = F.col("home") == F.col("cell")
    sizes = index.groupBy(*key).agg(F.count(F.when(hosts, 1)).alias("held"), F.count(F.when(~hosts, 1)).alias("guests"))
    parts = written(sizes.where("held > 0 AND held + guests > 1").select(
        *key, F.ceil(F.col("held") / part).alias("parts"), F.ceil(F.col("guests") / part).alias("guest_parts")), "cells")
    same = [F.col(f"i.{c}") == F.col(f"c.{c}") for c in key]
    salted = index.alias("i").join(parts.alias("c"), same).select("i.*", "parts", "guest_parts").withColumn(
        "salt", F.pmod(F.xxhash64("class"), F.when(hosts, F.col("parts")).otherwise(F.col("guest_parts"))))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("other")
    # residents: part against part; guests (numbered below zero): their part against each resident part
    residents = salted.where(hosts)
    among = residents.select(*salted.columns, other).select(
        *salted.columns, F.least("salt", "other").alias("a"), F.greatest("salt", "other").alias("b"), (F.col("salt") > F.col("other")).cast("int").alias("side"))
    asked = residents.where("guest_parts > 0").select(
        *salted.columns, F.explode(F.sequence(F.lit(0).cast("long"), F.col("guest_parts") - 1)).alias("g")).select(
        *salted.columns, (-1 - F.col("g")).alias("a"), F.col("salt").alias("b"), F.lit(1).alias("side"))
    asking = salted.where(~hosts).select(*salted.columns, other).select(
        *salted.columns, (-1 - F.col("salt")).alias("a"), F.col("other").alias("b"), F.lit(0).alias("side"))
    group = [*key, "a", "b"]
    dealt = among.unionByName(asked).unionByName(asking).select(*group, "side", "class", "home", "n", "x")

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for name, rows in runs(batches, group):
            _, dim, cell, a, b = name
            out = verified(shared.value[dim], cell, rows["class"].to_numpy(), rows["home"].to_numpy(), rows["n"].to_numpy(),
                           units(unpacked(rows["x"], dim)), rows["side"].to_numpy(), a == b)
            if out:
                yield pd.DataFrame(out, columns=["class", "other", "links"])

    return (
        dealt.repartition(*group).sortWithinPartitions(*group)
        .mapInPandas(found, "class long, other long, links long")
        .select("class", F.when(F.col("other") >= 0, F.col("other")).alias("other"), "links"))


def runs(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[tuple[tuple, pd.DataFrame]]:
    """The groups of rows sorted by `keys`, also where a group goes on in the next batch."""
    held: list[pd.DataFrame] = []
    name = None
    for batch in batches:
        named = list(zip(*(batch[k] for k in keys)))
        starts = [i for i in range(len(named)) if i == 0 or named[i] != named[i - 1]]
        for at, end in zip(starts, [*starts[1:], len(named)]):
            if named[at] != name and held:
                yield name, pd.concat(held, ignore_index=True) if len(held) > 1 else held[0].reset_index(drop=True)
                held = []
            name = named[at]
            held.append(batch.iloc[at:end])
    if held:
        yield name, pd.concat(held, ignore_index=True) if len(held) > 1 else held[0].reset_index(drop=True)


def unpacked(packed: pd.Series, dim: int) -> np.ndarray:
    """Rows from their bytes, single or double precision."""
    raw = packed.tolist()
    kind = np.float32 if len(raw[0]) == 4 * dim else np.float64
    return np.frombuffer(b"".join(raw), dtype=kind).reshape(len(raw), dim).astype(float)


# -- the operator -----------------------------------------------------------------------------------

def directions(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """vec_id, label, dim, digest of the direction and packed components; nulls where a row takes no part."""
    single = vectors.schema[vector].dataType.simpleString() == "array<float>"

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for x, known in zip(batch["x"], batch["known"]):
                if not known:
                    out.append((None, None, None))
                    continue
                row = np.asarray(x, dtype=np.float32 if single else np.float64)
                # adding zero turns -0.0 into 0.0
                mark = hashlib.blake2b((units(row.astype(float)[None])[0] + 0.0).tobytes(), digest_size=16).digest()
                out.append((len(row), mark, row.tobytes()))
            dims, marks, rows = zip(*out) if out else ((), (), ())
            yield pd.DataFrame({"vec_id": batch["vec_id"], "label": batch["label"], "dim": pd.array(dims, dtype="Int32"),
                                "digest": marks, "x": rows})

    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))
    known = F.coalesce(
        F.col(label).isNotNull() & F.forall(F.col(vector), finite) & F.exists(F.col(vector), lambda c: c != 0), F.lit(False))
    # ids and labels go through pandas as text, which keeps long ones exact beside nulls
    rows = vectors.select(F.col(key).cast("string").alias("vec_id"), F.col(label).cast("string").alias("label"),
                          known.alias("known"), F.when(known, F.col(vector)).alias("x"))
    return rows.mapInPandas(packed, "vec_id string, label string, dim int, digest binary, x binary").withColumn(
        "vec_id", F.col("vec_id").cast("long"))


def fit(classes: DataFrame, similar: float, recall: float) -> dict[int, Grid]:
    """A grid for each vector length. The number of codewords grows with the root of the largest label's
    classes; they are fitted to a sample by hash of about SAMPLE classes of a length, or SAMPLE_MB of them."""
    counts = classes.groupBy("dim", "label").count().groupBy("dim").agg(
        F.max("count").alias("largest"), F.sum("count").alias("total")).collect()  # a row per length
    grids = {}
    for dim, largest, total in counts:
        most = min(SAMPLE, max(256, SAMPLE_MB * 2**20 // (8 * dim)))
        rows = hash_sample(classes.where(F.col("dim") == dim), F.col("digest"), most, total).select("digest", "x").toPandas()
        rows = rows.sort_values("digest", key=lambda s: s.map(bytes))
        sample = units(unpacked(rows["x"], dim)) if len(rows) else np.zeros((0, dim))
        words = min(WORDS, 2 ** round(math.log2(max(4, math.sqrt(largest / CELL)))))
        grids[dim] = Grid(sample if len(sample) else np.zeros((1, dim)), words, similar, recall)
    return grids


def near_duplicates(
    vectors: DataFrame, key: str, vector: str, label: str, similar: float = SIMILAR, recall: float = RECALL, part: int = PART,
) -> DataFrame:
    """Per vector: vec_id, n_links (other vectors linked directly), component_id (least id reachable,
    its own included) and kept (whether it is that one)."""
    rows = written(directions(vectors, key, vector, label), "directions")
    members = rows.where("digest IS NOT NULL").select("vec_id", "label", "digest").distinct()
    alone = rows.where("digest IS NULL").select("vec_id").distinct()
    sums = members.groupBy("label", "digest").agg(F.min("vec_id").alias("least"), F.count("*").alias("n"))
    bodies = rows.where("digest IS NOT NULL").groupBy("label", "digest", "dim").agg(F.min("x").alias("x"))
    classes = written(sums.join(bodies, ["label", "digest"]).withColumn("class", F.monotonically_increasing_id()), "classes")
    pairs = written(near_pairs(classes, fit(classes, similar, recall), part), "vector-links")
    counts = pairs.where("other IS NULL").groupBy("class").agg(F.sum("links").alias("links"))
    roots = components(pairs.where("other IS NOT NULL").select(F.col("class").alias("u"), F.col("other").alias("v")))
    rooted = classes.join(counts, "class", "left").join(roots.withColumnRenamed("u", "class"), "class", "left").select(
        "label", "digest", "n", "least", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("v", "class").alias("root"))
    rooted = written(rooted, "rooted-classes")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = rooted.join(named, "root").select(
        "label", "digest", (F.col("n") - 1 + F.col("links")).alias("n_links"), "component_id")
    linked_rows = members.join(labels, ["label", "digest"]).select("vec_id", "n_links", "component_id")
    return linked_rows.unionByName(alone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
