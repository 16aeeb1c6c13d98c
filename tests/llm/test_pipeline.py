"""The pipeline against its operators' results, taken one by one and by brute force where one exists."""

from pyspark.sql import functions as F

import corpus_pipeline as cp
from samples import documents, no_documents
from test_simhash import groups, plain_fingerprint

FOLDER = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    ids = lambda frame: {r.doc_id for r in frame.select("doc_id").collect()}
    kept = cp.good_quality(spark, docs, FOLDER)
    assert kept.columns == docs.columns
    good, bad = ([i in ids(kept) for i, q in labels.items() if q == v] for v in (1, 0))
    assert sum(good) / len(good) > 0.99 and sum(bad) / len(bad) < 0.05
    assert ids(cp.known_language(spark, kept, FOLDER)) == ids(kept)  # all of these are in a known language

    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    prints = [plain_fingerprint(t) for _, t in rows]
    expected = {rows[g][0] for g in groups(prints)}
    assert ids(cp.one_of_each(spark, docs, FOLDER)) == expected

    plain = lambda text: " " + " ".join("".join(c if c.isalnum() or c == "_" else " " for c in text.lower()).split()) + " "
    items = [plain(r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    clean = cp.without_benchmarks(spark, docs, FOLDER)
    assert ids(clean) == {i for i, t in rows if not any(x in plain(t) for x in items)} and clean.columns == docs.columns


def test_run(spark):
    done = cp.run(spark, FOLDER)
    assert {"doc_id", "ids", "ends", "decoded", "n_tokens"} == set(done.columns)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    rows = done.join(docs, "doc_id").select("text", "decoded", "n_tokens", F.size("ids").alias("n")).collect()
    assert 600 < len(rows) < 900 and all(r.text == r.decoded and r.n == r.n_tokens for r in rows)


def test_odd_rows_pass_every_stage(spark, tmp_path):
    for name, schema in (("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    for docs in (documents(spark), no_documents(spark)):
        left = docs
        for name, stage in cp.STAGES[:-1]:
            left = stage(spark, left, str(tmp_path))
            assert left.columns == docs.columns, name
        ids = [r.doc_id for r in left.collect()]
        # blank texts go, letters must be there, copies and repeated rows are one; a null id stays
        assert sorted(ids, key=str) == ([] if docs.isEmpty() else [10, 12, 13, 4, 5, 6, 7, 8, None]) or sorted(i for i in ids if i is not None) == sorted(set(i for i in ids if i is not None))
        assert cp.STAGES[-1][1](spark, left, str(tmp_path)).count() == len(ids)
