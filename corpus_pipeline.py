"""A corpus pipeline over `documents`: each stage works on what the one before it kept.

All stages but the last return the columns of their input. Rows with a null doc_id are judged by
their text like any other, but duplicates among them cannot be told apart by id and stay; rows that
share a doc_id are one document. Null and blank texts are rejected by the first stage; without
labels it keeps every other text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.llm import decontamination, language_id, quality, sentence_pieces, simhash
from ledgerloom.llm.common import fold, table, vocabulary_path, written
from ledgerloom.llm.queries import GOOD

SURE = 0.5  # posterior below which a language is not decided


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose joint score of text and metadata says good quality."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = quality.learn(docs, labels, "doc_id", "text", "lang", "source", "n_chars")
    score = quality.scored(docs, model, *map(F.col, ("text", "lang", "source", "n_chars")))
    return docs.where(score["score"] >= GOOD)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    model = language_id.fit(docs.where(fold(F.col("doc_id"), 4) != 2), "text", "lang")
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = language_id.predicted(docs, model, F.col("text"))
    return docs.where((found["lang"] != language_id.UNDECIDED) & (found["score"] >= SURE))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near-duplicates."""
    found = simhash.near_duplicates(docs, "doc_id", "text")
    kept = written(found.where("doc_id = component_id").groupBy("doc_id").count(), "kept")
    # texts are shuffled to the kept ids at every size; a broadcast would only suit a small corpus
    stay = docs.join(kept.select("doc_id").hint("merge"), "doc_id", "left_semi")
    repeated = kept.where("count > 1").select("doc_id")
    if not repeated.isEmpty():
        stay = stay.join(repeated, "doc_id", "left_anti").unionByName(
            stay.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"]))
    return stay.unionByName(docs.where("doc_id IS NULL")).select(docs.columns)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    spaces = decontamination.build(docs, "text", table(spark, sf_dir, "benchmark"), "item_id", "text")
    return docs.where(F.size(decontamination.leaks(docs, spaces, F.col("text"))) == 0)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids, span ends and decoded text of each document that is left."""
    pieces = sentence_pieces.encode(docs, "doc_id", "text", vocabulary_path("piece_bpe_32k.model"))
    return pieces.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("quality", good_quality),
    ("language", known_language),
    ("near_duplicates", one_of_each),
    ("decontamination", without_benchmarks),
    ("sentencepiece", encoded),
]

# Classifiers, fingerprints and pieces cannot be stated in SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
