import hashlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from ledgerloom.llm import warc
from ledgerloom.session import scratch_path
from oracle_check import compare, connect

FOLDER = "/root/testdata/sf0.001"
BIG = "<p>é" * 400


@pytest.mark.parametrize("name", ["op1_warc", "op10_vector_search"])
def test_queries_against_sql(spark, name):
    compare(contract.queries()[name](spark, FOLDER), connect(FOLDER), contract.oracle_sql()[name])


def archived(spark, rows):
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "1 AS digest", "2 AS size", "3 AS key", "4 AS header", "5 AS packed")
    folder = scratch_path(spark, "warc-test")
    warc.write(frame, "page_id", "url", "html", folder)
    return warc.read(spark, folder), folder


def test_edges(spark):
    records, folder = archived(spark, [
        (1, "http://a/1", BIG), (2, "http://a/2\r\nX: y", BIG), (3, None, BIG), (3, None, BIG),
        (4, "u", None), (5, "u", ""), (6, "u", "small"), (7, "u", "small"), (None, "u", BIG), (None, "v", "only" * 500)])
    found = sorted((tuple(r) for r in warc.summary(records).collect()), key=str)
    digest = lambda text: hashlib.sha1(text.encode()).hexdigest()
    size = len(BIG.encode())
    assert found == sorted([
        (1, size, digest(BIG), "revisit", 3), (2, size, digest(BIG), "revisit", 3),
        (3, size, digest(BIG), "response", None), (3, size, digest(BIG), "response", None),
        (4, 0, digest(""), "response", None), (5, 0, digest(""), "response", None),
        (6, 5, digest("small"), "response", None), (7, 5, digest("small"), "response", None),
        (None, size, digest(BIG), "revisit", 3), (None, 2000, digest("only" * 500), "response", None)], key=str)
    # each payload once, whatever the number of its records
    assert spark.read.parquet(f"{folder}/payloads").count() == 4


def test_records_are_whole(spark):
    records, _ = archived(spark, [(1, "http://a/1\r\nInjected: x", BIG), (2, "http://a/2", BIG)])
    blobs = {r.key: bytes(r.blob) for r in records.select("key", warc.record_bytes().alias("blob")).collect()}
    for key, kind, block in ((1, b"revisit", b""), (2, b"response", BIG.encode())):
        head, _, rest = blobs[key].partition(b"\r\n\r\n")
        lines = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        assert lines[b"WARC-Type"] == kind and int(lines[b"Content-Length"]) == len(block)
        assert b"Injected" not in lines
        assert rest == block + b"\r\n\r\n"


def test_damage_is_refused(spark):
    records, folder = archived(spark, [(1, "u", "x")])
    (spark.read.parquet(f"{folder}/payloads").withColumn("digest", F.sha2(F.lit("other").cast("binary"), 256))
     .write.parquet(f"{folder}-bad/payloads"))
    (spark.read.parquet(f"{folder}/headers").withColumn("digest", F.sha2(F.lit("other").cast("binary"), 256))
     .write.parquet(f"{folder}-bad/headers"))
    with pytest.raises(Exception, match="another digest"):
        warc.read(spark, f"{folder}-bad").collect()


def test_empty(spark):
    frame = spark.createDataFrame([], "page_id long, url string, html string")
    folder = scratch_path(spark, "warc-test")
    warc.write(frame, "page_id", "url", "html", folder)
    assert warc.summary(warc.read(spark, folder)).count() == 0
