import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerloom.llm import simhash
from ledgerloom.llm.components import components
from samples import documents, no_documents, prose


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if counts[b] * 2 > len(shingles))


def groups(prints):
    """Component of each place, by all pairs."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= simhash.MAX_BITS:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("bucket", [simhash.BUCKET, 2])
def test_documents(spark, bucket):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    found = {r.doc_id: r for r in simhash.near_duplicates(docs, "doc_id", "text", bucket).withColumn("x", simhash.hexadecimal("fp")).collect()}
    prints = [plain_fingerprint(t) for _, t in rows]
    assert [found[i].x for i, _ in rows] == [f"{p:016x}" for p in prints]
    assert [found[i].component_id for i, _ in rows] == [rows[g][0] for g in groups(prints)]


def test_dense_bucket_keeps_all_links(spark):
    """Many close fingerprints: chains whose ends are far apart are one component."""
    rng = np.random.default_rng(3)
    prints = [int(rng.integers(0, 1 << 63)) for _ in range(40)]
    for i in range(300):
        flipped = prints[i % 60]
        for b in rng.integers(0, 64, 3):
            flipped ^= 1 << int(b)
        prints.append(flipped)
    prints = sorted({p - (1 << 64) if p >= 1 << 63 else p for p in prints})
    frame = spark.createDataFrame([(p,) for p in prints], "fp long")
    expected = groups([p & (1 << 64) - 1 for p in prints])
    for bucket in (4, 2048):
        root = {r.u: r.v for r in components(simhash.links(frame, bucket)).collect()}
        assert [root.get(p, p) for p in prints] == [prints[g] for g in expected]


def test_components_of_a_chain(spark):
    edges = spark.range(200).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    assert {tuple(r) for r in components(edges).collect()} == {(i, 0) for i in range(1, 201)}
    assert components(edges.where("false")).count() == 0


def test_edges(spark):
    found = simhash.near_duplicates(documents(spark), "doc_id", "text").collect()
    assert len(found) == documents(spark).count()
    blank = {r.component_id for r in found if r.fp == 0}
    assert blank == {0}  # null, empty and white texts are one group
    same = [r for r in found if r.doc_id in (13, 14)]
    assert len(same) == 3 and {r.component_id for r in same} == {13}
    assert [r.component_id for r in found if r.doc_id is None] == [None]
    assert simhash.near_duplicates(no_documents(spark), "doc_id", "text").count() == 0


def test_upper_case_and_short_texts():
    assert simhash.fingerprint("A b C d") == simhash.fingerprint("a B\tc\nd")
    assert simhash.fingerprint("É x") != simhash.fingerprint("é x")  # A-Z only
    assert simhash.fingerprint(prose(1, 3)) & (1 << 64) - 1 == plain_fingerprint(prose(1, 3))
