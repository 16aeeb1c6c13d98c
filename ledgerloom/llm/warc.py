"""A content-addressed WARC archive.

Two tables: `payloads` holds every distinct payload once, gzip-compressed, under its SHA-256;
`headers` holds the exact header block of every record with the digest of its payload. A record is
header block, payload and the two line ends that close it; reading joins the tables on the digest,
recomputes the digest of what it got and refuses a payload that does not match.

Of records with equal payloads of at least `MIN_REVISIT` bytes, the one with the largest key is the
`response`, the others are `revisit`s that refer to it; all smaller records are responses.

Defined cases: a null payload is empty (and so a response); repeated rows each get a record, and if
they are the response all of them are; a null key never wins against a key, and a group of null
keys alone are all responses; line ends in an address are percent-encoded; an empty frame makes
empty tables; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

MIN_REVISIT = 1000  # bytes
CAPTURED = "1970-01-01T00:00:00Z"  # the pages carry no capture time
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CLOSE = b"\r\n\r\n"


@F.pandas_udf(T.BinaryType())
def _packed(payloads: pd.Series) -> pd.Series:
    return payloads.map(zlib.compress)


def _address(key: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(key.cast("string"), F.lit("none")), F.lit(">"))


def _lines(*pairs: tuple[str, Column]) -> Column:
    """Header lines; a line whose value is null is left out."""
    lines = [F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")) for name, value in pairs]
    return F.concat_ws("", F.lit("WARC/1.1\r\n"), *lines, F.lit("\r\n"))


def _read(pages: DataFrame, key: str, uri: str, payload: str) -> DataFrame:
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    return pages.select(F.col(key).alias("key"), F.col(uri).alias("uri"), body.alias("body")).select(
        "key", "uri", "body", F.octet_length("body").cast("long").alias("size"),
        F.sha2("body", 256).alias("digest"), F.sha1("body").alias("sha1"))


def write(pages: DataFrame, key: str, uri: str, payload: str, folder: str) -> None:
    """Archives one record per row of `pages` under `folder`."""
    spark = pages.sparkSession
    records = _read(pages, key, uri, payload)
    (records.select("digest", "size", _packed("body").alias("packed"))
     .groupBy("digest").agg(F.first("size").alias("size"), F.first("packed").alias("packed"))
     .write.option("compression", "uncompressed").parquet(f"{folder}/payloads"))
    # Only digests travel here; written first, so that a join with a hot digest can be split.
    (records.where(F.col("size") >= MIN_REVISIT).groupBy("digest")
     .agg(F.max("key").alias("winner"), F.count("*").alias("n")).where("n > 1").drop("n")
     .write.parquet(f"{folder}/repeated"))
    placed = records.drop("body").join(spark.read.parquet(f"{folder}/repeated"), "digest", "left")
    revisit = F.col("winner").isNotNull() & ~F.col("key").eqNullSafe(F.col("winner"))
    uri_line = F.regexp_replace(F.regexp_replace("uri", "\r", "%0D"), "\n", "%0A")
    header = _lines(
        ("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        ("WARC-Record-ID", _address(F.col("key"))),
        ("WARC-Date", F.lit(CAPTURED)),
        ("WARC-Target-URI", uri_line),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "sha1")),
        ("WARC-Refers-To", F.when(revisit, _address(F.col("winner")))),
        ("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        ("Content-Type", F.lit("text/html")),
        ("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("size")).cast("string")))
    (placed.select("key", header.cast("binary").alias("header"), "digest")
     .write.parquet(f"{folder}/headers"))


def read(spark: SparkSession, folder: str) -> DataFrame:
    """The archived records: key, exact header block, whole payload and its verified digest."""
    headers, payloads = (spark.read.parquet(f"{folder}/{t}") for t in ("headers", "payloads"))

    @F.pandas_udf("binary")
    def unpacked(packed: pd.Series, digests: pd.Series) -> pd.Series:
        out = packed.map(zlib.decompress)
        for body, digest in zip(out, digests):
            if hashlib.sha256(body).hexdigest() != digest:
                raise ValueError(f"the payload stored as {digest} has another digest")
        return out

    return headers.join(payloads, "digest").select("key", "header", unpacked("packed", "digest").alias("payload"))


def value(name: str) -> Column:
    """A header line's value, null if the record has no such line."""
    found = F.regexp_extract(F.col("header").cast("string"), f"\n{name}: ([^\r]*)\r\n", 1)
    return F.when(found != "", found)


def record_bytes() -> Column:
    """A record as it stands in a WARC file: a revisit has an empty block."""
    block = F.when(value("WARC-Type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return F.concat(F.col("header"), block, F.lit(CLOSE))


def summary(records: DataFrame) -> DataFrame:
    """What the read records say: key, payload size and SHA-1, record type, and who a revisit refers to."""
    refers = F.regexp_extract(value("WARC-Refers-To"), "^<urn:page:(.*)>$", 1)
    return records.select(
        "key", F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"), value("WARC-Type").alias("record_type"),
        refers.cast("long").alias("refers_to"))
