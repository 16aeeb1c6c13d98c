import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from ledgerloom.llm import toxicity as tx
from samples import documents, no_documents, prose

WORDS = ["blorgan", "frizzlewump", "skant"]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@pytest.mark.parametrize("seed", range(5))
def test_automaton_against_distances(seed):
    pick = random.Random(seed)
    terms = sorted({"".join(pick.choice("abc") for _ in range(pick.randint(2, 10))) for _ in range(12)})
    lexicon = tx.Lexicon(terms, set())
    for _ in range(400):
        word = pick.choice(terms) if pick.random() < 0.3 else "".join(pick.choice("abcd") for _ in range(pick.randint(1, 11)))
        if pick.random() < 0.5:
            at = pick.randrange(len(word))
            word = word[:at] + pick.choice(["", "a", "d"]) + word[at + pick.randint(0, 1) :]
        near = [(d, i) for i, t in enumerate(terms) if (d := distance(word, t)) <= tx.edits(t)]
        found = lexicon.match(word) if word else None
        if word:
            assert (found and (found[1], found[0])) == min(near, default=None)


def corpus(spark):
    rows, labels = [], []
    for i in range(240):
        words = prose(i, 40).split()
        if i % 4 == 0:
            for k, w in enumerate(WORDS):
                words.insert(7 * k + i % 5, w)
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, label int")


def scores(spark, texts, model):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.score for r in sorted(tx.score(docs, model, "text", "doc_id").collect())]


def test_learned_terms_misspellings_and_quotation(spark):
    docs, labels = corpus(spark)
    model = tx.learn(docs.join(labels, "doc_id"))
    assert set(model["terms"]) == set(WORDS)
    clean = prose(999, 40)
    plain, exact, typo, quoted, empty = scores(spark, [
        clean, "you " + WORDS[0] + " " + clean, "you blorgam, frizlewumpp " + clean,
        clean + ' they said the word "' + WORDS[0] + '" means nothing ' + clean, ""], model)
    assert plain < 0.1 and empty == plain and exact >= 0.7 and typo >= 0.7
    assert quoted < exact


def test_copies_do_not_make_a_term(spark):
    docs, labels = corpus(spark)
    copied = spark.createDataFrame([(1000 + i, prose(1, 40) + " rareword here") for i in range(60)], "doc_id long, text string")
    model = tx.learn(docs.join(labels, "doc_id").unionByName(copied.withColumn("label", F.lit(1))))
    assert "rareword" not in model["terms"]


def test_words_of_other_texts_are_exceptions(spark):
    docs, labels = corpus(spark)
    near = docs.where("doc_id % 4 = 1").withColumn("text", F.concat("text", F.lit(" blorgas")))
    model = tx.learn(docs.where("doc_id % 4 <> 1").unionByName(near).join(labels, "doc_id"))
    assert "blorgas" in model["exceptions"]
    assert scores(spark, ["a blorgas b", "a blorgan b"], model)[0] < 0.1


def test_held_out(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    rows = contract.queries()["op7_toxicity"](spark, folder).join(labels, "doc_id").where("held_out").collect()
    toxic, clean = ([r.predicted for r in rows if r.toxic == t] for t in (1, 0))
    assert sum(toxic) / len(toxic) > 0.9 and sum(clean) / len(clean) < 0.01


@pytest.mark.parametrize("labelled, share", [([], 0.0), ([(4, 0)], 0.0), ([(4, 1), (5, 1)], 1.0), ([(4, 1), (5, 0), (6, None)], 0.5)])
def test_edges(spark, labelled, share):
    docs = documents(spark)
    labels = spark.createDataFrame(labelled, "doc_id long, label int")
    model = tx.learn(docs.select("doc_id", "text").join(labels, "doc_id"))
    found = tx.score(docs, model, "text").collect()
    assert len(found) == docs.count() and {r.score for r in found} == {share} and {r.hits for r in found} == {0}
    assert tx.score(no_documents(spark), model, "text").count() == 0


def test_words_of_copied_texts_push_no_term_out(spark):
    """30,000 words, each unique to a group of copies of toxic texts, are no terms; the true ones stay."""
    docs, labels = corpus(spark)
    groups = spark.range(300).selectExpr(
        "concat_ws(' ', transform(sequence(0, 99), i -> concat('zq', id, 'x', i, 'y'))) AS text").crossJoin(spark.range(10).select()).withColumn(
        "doc_id", 1000 + F.monotonically_increasing_id()).withColumn("label", F.lit(1))
    clean = spark.range(30_000).selectExpr(
        "id + 100000 AS doc_id", "concat_ws(' ', 'plain', id % 7, 'words', id % 11, 'only') AS text", "0 AS label")
    model = tx.learn(docs.join(labels, "doc_id").unionByName(groups).unionByName(clean))
    assert set(model["terms"]) == set(WORDS)


def test_many_near_words_are_all_exceptions(spark):
    """300,000 clean words within two edits of a term: none counts as a misspelling, others still do."""
    docs, labels = corpus(spark)
    letters = "abcdefghijklmnopqrstuvwxyzäöüéèñ0123456789абвгдежзийклмнопр"
    one = [WORDS[1][:i] + a + WORDS[1][i + 1 :] for i in range(len(WORDS[1])) for a in letters]
    near = sorted({w[:i] + a + w[i:] for w in one for i in range(len(w) + 1) for a in letters} - set(WORDS))[:300_000]
    rows = spark.createDataFrame([(5000 + at, " ".join(near[at : at + 1000])) for at in range(0, len(near), 1000)], "doc_id long, text string")
    model = tx.learn(docs.join(labels, "doc_id").unionByName(rows.withColumn("label", F.lit(0))))
    assert set(WORDS) <= set(model["terms"])
    held = {r.word for r in model["exceptions"].table.collect()}
    assert len(near) == 300_000 and set(near) <= held
    found = tx.score(spark.createDataFrame([(0, near[0] + " a " + near[-1]), (1, "b " + WORDS[0][:-1] + "m")], "doc_id long, text string"), model, "text", "doc_id")
    assert {r.doc_id: r.hits for r in found.collect()} == {0: 0, 1: 1}


def test_scores_against_plain_sums(spark):
    """Spark's sums per row against the evidence of each text by itself, exceptions left out."""
    docs, labels = corpus(spark)
    near = docs.where("doc_id % 4 = 1").withColumn("text", F.concat("text", F.lit(" blorgas")))
    model = tx.learn(docs.where("doc_id % 4 <> 1").unionByName(near).join(labels, "doc_id"))
    lexicon, weights = tx.Lexicon(model["terms"]), list(model["terms"].values())
    texts = ["a blorgas b blorgam", "blorgan blorgan 'skant'", "", "frizlewump frizzlewum skannt said " + WORDS[2], "plain"]
    found = tx.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model, "text", "doc_id").collect()
    for r in found:
        exact, quoted, hits, others = tx.evidence(texts[r.doc_id], lexicon, weights)
        others = [n for n in others if n["word"] not in {"blorgas"}]
        want = (exact, sum(n["abuse"] for n in others if n["edits"] == 1), sum(n["abuse"] for n in others if n["edits"] == 2),
                quoted + sum(n["quoted"] for n in others))
        assert (r.exact, r.one, r.two, r.quoted) == pytest.approx(want) and r.hits == hits + sum(n["hits"] for n in others)
