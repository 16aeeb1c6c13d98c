import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import decontamination as dc
from samples import documents, no_documents, prose


def passage(seed, words=40):
    text = prose(seed, words, vocabulary=3000)
    parts = text.split()
    return " ".join(parts[: words // 2]) + ". " + " ".join(parts[words // 2 :]) + "?"


def planted(spark):
    items = [(i, passage(100 + i)) for i in range(12)]
    noise = lambda i, n: prose(1000 + i, n, vocabulary=3000)
    rows = [(i, noise(i, 300)) for i in range(60)]
    rows[3] = (3, noise(3, 100) + " " + items[3][1].upper() + " " + noise(4, 700))
    rows[4] = (4, items[4][1])
    words = items[5][1].split()
    pick = random.Random(5)
    for at in pick.sample(range(len(words)), 6):  # a paraphrase: some words replaced, one put in
        words[at] = "other" + str(at)
    words.insert(7, "indeed")
    rows[5] = (5, noise(5, 57) + " " + " ".join(words) + " " + noise(6, 61))
    half = items[6][1].split()[:14]
    rows[6] = (6, noise(7, 100) + " " + " ".join(half) + " " + noise(8, 100))  # too little of it
    shuffled = items[7][1].split()
    pick.shuffle(shuffled)
    rows[7] = (7, noise(9, 50) + " " + " ".join(shuffled) + " " + noise(10, 50))  # the words without their order
    rows.append((5, rows[5][1]))
    return (spark.createDataFrame(rows, "doc_id long, text string").withColumn("items", F.lit(1)),
            spark.createDataFrame(items + [(99, None), (98, " ")], "item_id long, text string").withColumn("words", F.lit(1)))


def found(docs, benchmark):
    spaces = dc.build(docs, "text", benchmark, "item_id", "text")
    rows = docs.select("doc_id", F.explode(dc.leaks(docs, spaces, F.col("text"))).alias("l")).select("doc_id", "l.*").collect()
    return sorted((r.doc_id, r.item_id) for r in rows), rows


def test_planted(spark):
    docs, benchmark = planted(spark)
    pairs, rows = found(docs, benchmark)
    assert pairs == [(3, 3), (4, 4), (5, 5), (5, 5)]
    assert all(0 < r.cosine <= 1.0001 and 0 < r.lcs <= 1 for r in rows)


def test_several_spaces(spark, monkeypatch):
    monkeypatch.setattr(dc, "GROUP", 5)
    monkeypatch.setattr(dc, "SPACES", 2)
    assert found(*planted(spark))[0] == [(3, 3), (4, 4), (5, 5), (5, 5)]


def test_given_documents_hold_exactly_the_items_found(spark):
    folder = "/root/testdata/sf0.01"
    docs, benchmark = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    plain = lambda text: " " + " ".join("".join(c if c.isalnum() or c == "_" else " " for c in text.lower()).split()) + " "
    items = [(r.item_id, plain(r.text)) for r in benchmark.collect()]
    expected = sorted((r.doc_id, i) for r in docs.collect() for i, t in items if t in plain(r.text))
    assert found(docs, benchmark)[0] == expected


def test_long_items_are_cut_into_passages(spark):
    item = prose(7, 150, vocabulary=3000)
    docs = spark.createDataFrame([(1, prose(8, 80) + " " + " ".join(item.split()[64:128]) + " " + prose(9, 80)), (2, prose(10, 300))], "doc_id long, text string")
    assert found(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))[0] == [(1, 1)]


def test_edges(spark):
    docs, benchmark = documents(spark), spark.createDataFrame([(1, passage(1)), (None, "the same text")], "item_id long, text string")
    pairs = found(docs, benchmark)[0]
    assert pairs == [(13, None), (14, None), (14, None)]
    assert found(no_documents(spark), benchmark)[0] == []
    assert found(docs, benchmark.where("false"))[0] == []


@pytest.mark.parametrize("seed", range(20))
def test_common_subsequence(seed):
    pick = random.Random(seed)
    a, b = ([pick.randrange(5) for _ in range(pick.randint(1, 70))] for _ in range(2))
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    assert dc.common_subsequence(dc._masks(np.array(a)), len(a), b) == table[-1][-1]


def test_words_and_vocabulary():
    starts, hashes = dc.word_hashes("ab, ab cd_1 é".encode())
    assert starts.tolist() == [0, 4, 7, 12] and hashes[0] == hashes[1] and len(set(hashes.tolist())) == 3
    assert len(dc.word_hashes(b"")[0]) == len(dc.word_hashes(b" .")[0]) == 0
    low = np.array([5, 5 + (1 << 40), 9], dtype=np.uint64)  # two words share a slot
    vocabulary = dc.Vocabulary(low)
    assert vocabulary(np.array([9, 5 + (1 << 40), 5, 5 + (1 << 41), 7], dtype=np.uint64)).tolist() == [2, 1, 0, -1, -1]


def test_basis_keeps_the_passages(spark):
    docs, benchmark = planted(spark)
    space = dc.build(docs, "text", benchmark, "item_id", "text")[0]
    vocabulary = dc.Vocabulary(space["words"])
    idf_basis = space["rows"]
    gram = np.array([idf_basis[vocabulary(p)].sum(axis=0) for p in space["passages"]])
    assert np.linalg.matrix_rank(gram) == len(space["passages"])


def test_all_items_back_to_back(spark):
    """A document that lists the items one after another; short items fill only a part of their windows."""
    items = [(i, passage(500 + i, 9 + i % 30)) for i in range(60)]
    docs = spark.createDataFrame([(1, " ".join(t for _, t in items))] + [(2 + i, prose(2000 + i, 200, vocabulary=3000)) for i in range(40)], "doc_id long, text string")
    assert found(docs, spark.createDataFrame(items, "item_id long, text string"))[0] == [(1, i) for i, _ in items]


def test_every_passage_of_the_corpus_counts(spark):
    """The corpus part of the space comes from all passages of all texts: their products add up to the dense ones."""
    words = [f"w{i}" for i in range(9)]
    texts = [" ".join(words[(i * j) % 9] for j in range(1 + 37 * i)) for i in range(6)] + [None, "", "other words"]
    hashes = np.sort(next(dc.hashed([" ".join(words)]))[1][0])
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    corpus = dc._corpus(docs, "text", hashes)
    idf, place = np.linspace(1, 2, 9), np.arange(9)
    place[4], place[5:] = -1, place[5:] - 1
    idf = np.delete(idf, 4)
    block, total = np.random.default_rng(1).standard_normal((8, 3)).astype(np.float32), np.zeros((8, 3), dtype=np.float32)
    dc._products(corpus.toPandas(), place, idf, block, total)
    own = dc.Vocabulary(np.delete(hashes, 4))
    rows = []
    for text in texts:
        part = next(dc.hashed([text]))[1][0]
        rows += [dc._weights(own(part[at : at + dc.PASSAGE]), idf) for at in range(0, len(part), dc.PASSAGE)]
    assert np.allclose(total, np.array(rows).T @ (np.array(rows) @ block), atol=1e-3)
    sizes = corpus.selectExpr("sum(octet_length(passages)) / 4").first()[0]
    assert sizes == sum(np.any(r) for r in rows) or sizes == sum(-(-(1 + 37 * i) // dc.PASSAGE) for i in range(6))


def test_one_pass_gives_the_same_space(spark, monkeypatch):
    """The square added up once, and the products of each round, lead to the same directions."""
    texts = [prose(300 + i, 1 + 37 * i, vocabulary=60) for i in range(12)] + [None, "", "9 8 7"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    words = np.unique(next(dc.hashed([" ".join(t for t in texts[:9])]))[1][0])
    corpus = dc._corpus(docs, "text", words)
    frequency, n = dc.document_frequencies(corpus, len(words))
    sets = [set(next(dc.hashed([t]))[1][0].tolist()) for t in texts]
    assert n == sum(len(x) > 0 for x in sets) and frequency.tolist() == [sum(w in x for x in sets) for w in words.tolist()]
    place, idf = np.arange(len(words)), np.linspace(1, 2, len(words))
    place[2] = -1
    place[3:] -= 1
    idf = np.delete(idf, 2)
    rows = []
    for text in texts:
        part = next(dc.hashed([text]))[1][0]
        own = dc.Vocabulary(np.delete(words, 2))
        rows += [dc._weights(own(part[at : at + dc.PASSAGE]), idf) for at in range(0, len(part), dc.PASSAGE)]
    assert np.allclose(dc._square(corpus, place, idf), np.array(rows).T @ np.array(rows), atol=1e-4)
    own = np.array(rows[:3], dtype=np.float32)
    once = dc._basis(corpus, 0.3, own, place, idf)
    monkeypatch.setattr(dc, "GRAM_WORDS", 0)
    rounds = dc._basis(corpus, 0.3, own, place, idf)
    assert np.allclose(once @ once.T, rounds @ rounds.T, atol=1e-2)


def test_long_words_and_long_texts_hash_alike():
    """A word has one hash wherever it stands, in data of any length."""
    words = ["a", "z" * 70, "b" * 3, "z" * 71, "é" * 40]
    data = (" ".join(words) + " ").encode()
    alone = [int(dc.word_hashes(w.encode())[1][0]) for w in words]
    assert len(set(alone)) == len(words)
    again = dc.word_hashes(b"-" * (3 * dc.BLOB) + data * 2)[1].tolist()
    assert again == alone * 2
