import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import merkle
from samples import LONG, documents, no_documents


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def lower(text):
    return text if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def levels(nodes):
    """All levels of a tree, leaves first."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def plain(rows):
    """The contract on whole lists."""
    def leaf(r, text):
        return sha("".join(map(field, (r["doc_id"], r["source"], r["lang"], r["n_chars"], text))))

    trees = {}
    for r in rows:
        trees.setdefault(r["lang"], []).append(r)
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = {}
    for lang in langs:
        trees[lang].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        built[lang] = levels([leaf(r, r["text"]) for r in trees[lang]])
    top = levels([built[lang][-1][0] for lang in langs])
    out = []
    for t, lang in enumerate(langs):
        for i, r in enumerate(trees[lang]):
            way, at = [], i
            for nodes in built[lang][:-1]:
                way.append((nodes[at - at % 8 : at], nodes[at + 1 : at - at % 8 + 8]))
                at //= 8
            at = t
            for nodes in top[:-1]:
                way.append((nodes[at - at % 8 : at], nodes[at + 1 : at - at % 8 + 8]))
                at //= 8
            changed = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0
            node = leaf(r, lower(r["text"]) if changed else r["text"])
            for a, b in way:
                node = sha("".join(a) + node + "".join(b))
            out.append((r["doc_id"], built[lang][0][i], built[lang][-1][0], top[-1][0],
                        sha("".join("".join(a + b) for a, b in way)), node, node == top[-1][0]))
    return sorted(out, key=str)


def check(docs, tall):
    rows = [r.asDict() for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    found = merkle.documents_manifest(docs, tall=tall)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = sorted((tuple(r) for r in found.collect()), key=str)
    assert got == plain(rows)
    return got


@pytest.mark.parametrize("tall", [1, 4])
def test_documents(spark, tall):
    """Segments of 8 leaves take several rounds."""
    got = check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), tall)
    assert {r[-1] for r in got} == {True, False}


def test_odd_rows(spark):
    docs = documents(spark, [None, "", " ", "A", "a", "É ÀB", "same", "same", LONG, "漢字 X"])
    many = docs.unionByName(docs.withColumn("lang", F.lit("é"))).unionByName(docs.withColumn("lang", F.lit("")))
    check(many.unionByName(many.where("doc_id = 6")).withColumn("number", F.lit("x")).withColumn("tree", F.lit(3)), 1)
    big = docs.limit(1).withColumns({"doc_id": F.lit(2**62 + 1), "n_chars": F.lit(None).cast("long"), "source": F.lit(None).cast("string")})
    check(big.unionByName(docs), 2)


def test_one_and_none(spark):
    check(documents(spark, ["Alone"]).limit(1), 4)
    assert merkle.documents_manifest(no_documents(spark)).collect() == []


def test_many_trees(spark):
    """More trees than a run holds, one with most of the rows."""
    docs = spark.range(700).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN concat('l', id % 90) ELSE 'hot' END AS lang",
                                       "'s' AS source", "1L AS n_chars", "concat('Text ', id % 50) AS text")
    check(docs, 1)


@pytest.mark.parametrize("size", [1, 2, 7, 8, 9, 63, 64, 65, 73, 512, 513, 600])
def test_positions_and_siblings(size):
    """The closed form names the place at which a builder writes each node."""
    leaves = [sha(str(i)) for i in range(size)]
    tree, tall = levels(leaves), merkle.height(size)
    log = merkle.build(leaves, tall)
    assert len(log) == sum(map(len, tree))
    for level, nodes in enumerate(tree):
        assert [log[merkle.position(i, level, size)] for i in range(len(nodes))] == nodes
    for i in {0, size // 2, size - 1}:
        assert merkle.folded(leaves[i], merkle.siblings("".join(log), i, size, tall)) == log[-1]


@pytest.mark.parametrize("tall", [1, 2])
def test_log_and_lookup(spark, tall):
    """The log over several rounds is one postorder log per tree; a few proofs are found by position alone."""
    sizes = {0: 600, 1: 1, 2: 65, 3: 9}
    rows = [(t, i, n, sha(f"{t} {i}")) for t, n in sizes.items() for i in range(n)]
    rounds = merkle.forest(spark.createDataFrame(rows, "tree long, number long, size long, digest string"), tall)
    log = merkle.log_rows(rounds, tall)
    held = {(r.tree, r.position): (r.level, r.number, r.digest) for r in log.collect()}
    assert len(held) == log.count()
    for t, n in sizes.items():
        tree = levels([sha(f"{t} {i}") for i in range(n)])
        assert {p: v for (u, p), v in held.items() if u == t} == {
            merkle.position(i, level, n): (level, i, d) for level, nodes in enumerate(tree) for i, d in enumerate(nodes)}
    wanted = [(0, 0, 600), (0, 599, 600), (0, 300, 600), (1, 0, 1), (2, 64, 65)]
    found = merkle.lookup(log, spark.createDataFrame(wanted, "tree long, number long, whole long"))
    whole = {t: merkle.build([sha(f"{t} {i}") for i in range(n)], merkle.height(n)) for t, n in sizes.items()}
    for r in found.collect():
        path = merkle.siblings("".join(whole[r.tree]), r.number, sizes[r.tree], merkle.height(sizes[r.tree]))
        assert "".join(r.siblings) == "".join(a + b for a, b in path)
