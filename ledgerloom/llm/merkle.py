"""Merkle manifest of a dataset with a postorder append log.

Every row is a leaf: the SHA-256 of its fields, each written as its byte count, a colon and its value,
or as `-` if null. The leaves of a tree are numbered in order; every `FAN` consecutive nodes of a level
(the last run may be shorter) become one node of the next, the SHA-256 of their digests as hex text,
until one node is left. The trees' last nodes, in order of their tree, are the leaves of a top tree.

Numbers are dealt without a task that sees a whole tree: rows are sorted by range over all partitions
and written; a leaf's number is its place in its partition plus the leaves of its tree before it.

Builders are aligned: each takes `FAN ** HEIGHT` consecutive leaves that begin at a multiple of that
number, and appends every node to its segment of the log at the moment the node is complete, which is
postorder. The builders' own last nodes are the leaves of the next round, so n leaves take
log(n) / log(FAN ** HEIGHT) rounds and a builder never holds more than one segment.

A node's position needs no index: before leaf j, j leaves and floor(j / FAN ** l) nodes of each level
l are complete, and a node follows its last leaf by as many places as its level. An extractor finds
the siblings of a path in the segment by this closed form, joins the path of the segment's last node
from the round above, and folds each leaf, or its changed copy, up to the root.

Defined cases: repeated rows are a leaf each, side by side; null ids come first; texts may be of any
length (digests are made before rows move); an empty frame has no leaf, no root and gives an empty
result; other columns are ignored. A tree of one leaf is that leaf.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.merge import union
from .common import fold, written

FAN = 8
HEIGHT = 4   # levels of a segment: a builder takes up to 8 ** 4 leaves
WIDTH = 64   # characters of a digest

PATH = "array<struct<left:string,right:string>>"


# -- leaves -----------------------------------------------------------------------------------------

def field(column: Column) -> Column:
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*columns: Column) -> Column:
    """The leaf of the given fields, in lower-case hex."""
    return F.sha2(F.concat(*map(field, columns)).cast("binary"), 256)


def numbered(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """`rows` with `number`, their place from 0 in their tree by `order`, and `size`, the tree's rows.

    Rows that are equal in all of `order` may be numbered in any way. A tree with most of the rows,
    or one row repeated, is cut by range like any other.
    """
    keys = [tree, *order]
    ranged = rows.withColumn("_came", F.monotonically_increasing_id()).repartitionByRange(*keys, "_came")
    placed = written(
        ranged.sortWithinPartitions(*keys).drop("_came").withColumn("_at", F.monotonically_increasing_id()), "sorted-leaves"
    ).withColumn("_part", F.shiftright("_at", 33))
    # a partition holds a range of trees, so there are no more pairs than partitions and trees
    pairs = placed.groupBy(tree, "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    whole, before = Window.partitionBy(tree), Window.partitionBy(tree).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = written(pairs.select(
        F.col(tree).alias("_tree"), F.col("_part").alias("_in"), F.sum("_n").over(whole).alias("size"),
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift")), "leaf-offsets")
    same = F.col(tree).eqNullSafe(F.col("_tree")) & (F.col("_part") == F.col("_in"))
    return placed.join(starts, same).withColumn("number", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_tree", "_in", "_shift")


# -- closed form ------------------------------------------------------------------------------------

def height(size: int) -> int:
    """Levels above the leaves of a tree."""
    levels = 0
    while size > 1:
        size, levels = -(-size // FAN), levels + 1
    return levels


def position(number: int, level: int, size: int) -> int:
    """Place in the log of the node `number` of `level`, in a tree of `size` leaves."""
    leaf = min((number + 1) * FAN ** level, size) - 1
    place, done = level, leaf
    while done:
        place, done = place + done, done // FAN
    return place


def level_size(size: int, level: int) -> int:
    return -(-size // FAN ** level)


# -- builders and extractors ------------------------------------------------------------------------

def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def build(leaves: list[str], levels: int) -> list[str]:
    """The segment of an aligned builder: all its nodes up to `levels`, in the order they are complete."""
    log: list[str] = []
    open_runs: list[list[str]] = [[] for _ in range(levels + 1)]
    for at, leaf in enumerate(leaves, 1):
        node, last = leaf, at == len(leaves)
        for level in range(levels + 1):
            log.append(node)
            open_runs[level].append(node)
            if level == levels or not (last or len(open_runs[level]) == FAN):
                break
            node = sha("".join(open_runs[level]))
            open_runs[level] = []
    return log


def levels_of(size: int, tall: int) -> int:
    """Levels that a segment of a tree of `size` leaves spans."""
    return min(tall, height(size))


def siblings(log: str, number: int, size: int, levels: int) -> list[tuple[str, str]]:
    """Per level of a segment: the digests left and right of the path of its leaf `number`, read at
    the places that the closed form gives; `size` is the segment's number of leaves."""
    path = []
    for level in range(levels):
        first, end = number - number % FAN, level_size(size, level)
        run = [log[p : p + WIDTH] for p in (WIDTH * position(i, level, size) for i in range(first, min(first + FAN, end)))]
        path.append(("".join(run[: number - first]), "".join(run[number - first + 1 :])))
        number //= FAN
    return path


def folded(leaf: str, path: list[tuple[str, str]]) -> str:
    for left, right in path:
        leaf = sha(left + leaf + right)
    return leaf


def segments(leaves: DataFrame, tall: int) -> DataFrame:
    """One round of builders: `leaves` (tree, number, size, digest) to a row per segment with its log
    and its last node, `root`. Grouped by segment; a segment has a bounded number of leaves."""
    def built(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("number")
        log = build(group["digest"].tolist(), levels_of(int(group["size"].iloc[0]), tall))
        first = group.iloc[0]
        return pd.DataFrame([(first["tree"], first["block"], first["size"], first["whole"], len(group), "".join(log), log[-1])],
                            columns=["tree", "block", "size", "whole", "leaves", "log", "root"])

    blocked = leaves.select("tree", F.expr(f"number div {FAN ** tall}").alias("block"), "number", "size", "whole", "digest")
    return blocked.groupBy("tree", "block").applyInPandas(
        built, "tree long, block long, size long, whole long, leaves long, log string, root string")


def forest(leaves: DataFrame, tall: int = HEIGHT) -> list[DataFrame]:
    """The written segments of all rounds, lowest first; a tree is complete in the round in which it
    has one segment."""
    rounds, leaves = [], leaves.withColumn("whole", F.col("size"))
    while True:
        found = written(segments(leaves, tall), "merkle-log")
        rounds.append(found)
        if found.where("block > 0").isEmpty():
            return rounds
        leaves = found.where(F.col("size") > FAN ** tall).select(
            "tree", F.col("block").alias("number"), F.ceil(F.col("size") / FAN ** tall).alias("size"), "whole",
            F.col("root").alias("digest"))


def roots(rounds: list[DataFrame], tall: int = HEIGHT) -> DataFrame:
    """(tree, root) of every tree."""
    return union([r.where(F.col("size") <= FAN ** tall).select("tree", "root") for r in rounds])


def with_paths(rounds: list[DataFrame], above: DataFrame, tall: int = HEIGHT) -> DataFrame:
    """The lowest round's segments with `path`, the siblings from their last node up to the root.

    `above` (tree, path) goes on from each tree's own root. Each round hands its leaves' paths down to
    the segments they stand for.
    """
    handed = None
    for found in reversed(rounds):
        own = found.where(F.col("size") <= FAN ** tall).join(above, "tree")
        if handed is not None:
            own = own.unionByName(found.where(F.col("size") > FAN ** tall).join(handed, ["tree", "block"]))
        own = written(own, "merkle-paths")
        handed = leaf_paths(own, tall).withColumnRenamed("number", "block")
    return own


def leaf_paths(found: DataFrame, tall: int = HEIGHT) -> DataFrame:
    """(tree, number, path) of each leaf of the segments, from the leaf up to the root."""
    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for s in batch.itertuples():
                rest = [(p["left"], p["right"]) for p in s.path]
                paths = [siblings(s.log, i, s.leaves, levels_of(s.size, tall)) + rest for i in range(s.leaves)]
                yield pd.DataFrame({
                    "tree": s.tree, "number": [s.block * FAN ** tall + i for i in range(s.leaves)],
                    "path": [[{"left": a, "right": b} for a, b in path] for path in paths]})

    return found.select("tree", "block", "size", "leaves", "log", "path").mapInPandas(listed, f"tree long, number long, path {PATH}")


def proofs(leaves: DataFrame, found: DataFrame, tall: int = HEIGHT) -> DataFrame:
    """`leaves` (key, tree, number, digest, changed) with proof_sha256, the digest of their siblings up
    to the root, and folded_root, the root that `changed` (or the leaf, if null) leads to.

    A task extracts the proofs of one segment at a time from the segment's log and path.
    """
    def extracted(rows: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        segment = held.iloc[0]
        rest = [(p["left"], p["right"]) for p in segment["path"]]
        tail, levels, out = "".join(a + b for a, b in rest), levels_of(segment["size"], tall), []
        for number, leaf, changed in zip(rows["number"], rows["digest"], rows["changed"]):
            path = siblings(segment["log"], number % FAN ** tall, segment["leaves"], levels)
            out.append((sha("".join(a + b for a, b in path) + tail), folded(changed or leaf, path + rest)))
        return rows[["key", "digest", "tree"]].assign(proof_sha256=[o[0] for o in out], folded_root=[o[1] for o in out])

    blocked = leaves.select("key", "tree", F.expr(f"number div {FAN ** tall}").alias("block"), "number", "digest", "changed")
    return blocked.groupBy("tree", "block").cogroup(found.groupBy("tree", "block")).applyInPandas(
        extracted, "key string, digest string, tree long, proof_sha256 string, folded_root string")


# -- the log as a table -----------------------------------------------------------------------------

def log_rows(rounds: list[DataFrame], tall: int = HEIGHT) -> DataFrame:
    """The log of each tree: (tree, position, level, number, digest) of every node, once."""
    def listed(number: int):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for s in batch.itertuples():
                    nodes = []
                    for level in range(min(number, 1), levels_of(s.size, tall) + 1):
                        shift = s.block * FAN ** (tall - level)
                        for i in range(level_size(s.leaves, level)):
                            at, deep = WIDTH * position(i, level, s.leaves), level + tall * number
                            nodes.append((s.tree, position(i + shift, deep, s.whole), deep, i + shift, s.log[at : at + WIDTH]))
                    yield pd.DataFrame(nodes, columns=["tree", "position", "level", "number", "digest"])
        return run

    return union([
        found.mapInPandas(listed(number), "tree long, position long, level int, number long, digest string")
        for number, found in enumerate(rounds)])


def lookup(log: DataFrame, wanted: DataFrame) -> DataFrame:
    """Proofs of a few leaves from the log alone: `wanted` (tree, number, whole) to (tree, number,
    siblings), the digests in proof order, found by their positions."""
    @F.pandas_udf("array<struct<level:int,place:long,position:long>>")
    def needed(numbers: pd.Series, wholes: pd.Series) -> pd.Series:
        out = []
        for number, whole in zip(numbers, wholes):
            places = []
            for level in range(height(whole)):
                first = number - number % FAN
                places += [{"level": level, "place": i, "position": position(i, level, whole)}
                           for i in range(first, min(first + FAN, level_size(whole, level))) if i != number]
                number //= FAN
            out.append(places)
        return pd.Series(out)

    places = wanted.select("tree", "number", F.explode_outer(needed("number", "whole")).alias("w")).select("tree", "number", "w.*")
    met = places.join(log.select("tree", "position", "digest"), ["tree", "position"], "left")
    ordered = F.sort_array(F.collect_list(F.when(F.col("digest").isNotNull(), F.struct("level", "place", "digest"))))
    return met.groupBy("tree", "number").agg(F.transform(ordered, lambda n: n["digest"]).alias("siblings"))


# -- the operator -----------------------------------------------------------------------------------

def manifest(docs: DataFrame, key: str, tree: str, leaf: Column, changed: Column, tall: int = HEIGHT) -> DataFrame:
    """Per row of `docs`: doc_id, leaf, subroot, root, proof_sha256, folded_root and verified.

    `tree` names the column whose values have a tree each (null is one of them), ordered bytewise;
    `changed` is the leaf of a changed copy whose proof is tried, null where the row's own is.
    """
    spark = docs.sparkSession
    hashed = docs.select(F.col(key).cast("long").alias("key"), F.col(tree).cast("string").alias("tree"), leaf.alias("digest"), changed.alias("changed"))
    rows = numbered(hashed, "tree", ["key", "digest"])
    # trees are counted like leaves: by range, with their numbers written
    names = numbered(rows.select("tree").distinct().withColumn("top", F.lit(0)), "top", ["tree"])
    names = written(names.select("tree", F.col("number").alias("id")), "trees")
    with_id = rows.alias("r").join(names.alias("t"), F.col("r.tree").eqNullSafe(F.col("t.tree")))
    # ids go through pandas as text, which keeps long ones exact beside nulls
    leaves = written(with_id.select(F.col("key").cast("string"), F.col("id").alias("tree"), "number", "size", "digest", "changed"), "leaves")
    rounds = forest(leaves.select("tree", "number", "size", "digest"), tall)
    subroots = written(roots(rounds, tall), "subroots")
    trees = names.count()
    top = forest(subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("number"), F.lit(trees).cast("long").alias("size"), F.col("root").alias("digest")), tall)
    whole = spark.createDataFrame([(0, [])], f"tree long, path {PATH}")
    above = written(leaf_paths(with_paths(top, whole, tall), tall).select(F.col("number").alias("tree"), "path"), "tree-paths")
    proved = proofs(leaves, with_paths(rounds, above, tall), tall)
    summit = roots(top, tall).select("root")
    # one root, one row per tree: joined like any table
    ends = written(subroots.withColumnRenamed("root", "subroot").withColumn("one", F.lit(0)).join(
        summit.withColumn("one", F.lit(0)), "one").select("tree", "subroot", "root"), "roots")
    return proved.join(ends, "tree").select(
        F.col("key").cast("long").alias("doc_id"), F.col("digest").alias("leaf"), "subroot", "root", "proof_sha256", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))


def documents_manifest(docs: DataFrame, tampered: int = 3, tall: int = HEIGHT) -> DataFrame:
    """The manifest of a table of documents, a tree per language. Copies of rows whose id's crc32 is
    divisible by `tampered`, with the letters A-Z of their text lower-cased, are tried as changed."""
    def leaf(text: Column) -> Column:
        return digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)

    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return manifest(docs, "doc_id", "lang", leaf(F.col("text")), F.when(fold(F.col("doc_id"), tampered) == 0, leaf(lower)), tall)
