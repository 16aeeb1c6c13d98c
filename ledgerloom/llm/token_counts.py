"""Token counts by overlap resynchronisation.

A text up to `chunk_chars` is counted in one go. A longer one becomes chunks, each reaching
`overlap_chars` back into its predecessor, that Spark spreads over tasks. Every chunk is encoded by
itself with byte offsets; neighbours are spliced at a boundary that both have inside the overlap:

* In the left chunk a pre-token start is certain if it lies `MARGIN` bytes or more before the cut,
  because the pre-tokenizer scans from left to right and looks fewer bytes ahead than that, and no
  special string is longer.
* From a certain start on, the right chunk's own scan is the scan of the whole text, because the
  pre-tokenizer never looks back, and merges stay inside a pre-token.

So the spliced count is exact. Where no boundary is common (one word longer than the overlap), the
text is chunked again with an overlap `WIDER` times as large, at last as one chunk.

Input: any frame. Null text counts as empty (0 bytes, 0 tokens); null ids and repeated rows each
keep their own row; an empty frame gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from .common import file_bytes, written

MARGIN = 64      # bytes before a cut whose boundaries are not trusted
WIDER = 8        # growth of the overlap when an alignment fails
CACHE = 400_000  # words whose counts a task remembers; it bounds memory, not the result

_SPACE_AFTER_SPACE = re.compile(r"[\s᠎] ")
_WORD_STARTS = re.compile(r"(?<=[^\s᠎]) ")


def load(model: bytes):
    """The tokenizer of a vocabulary file, in the library's default handling of special strings."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_buffer(model)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def margin_holds(tokenizer) -> bool:
    longest = max((len(t.content.encode()) for t in tokenizer.get_added_tokens_decoder().values()), default=0)
    return longest + 8 <= MARGIN


class WordCounter:
    """Counts a text's tokens word by word, remembering words.

    A byte-level pre-tokenizer always starts a pre-token at a space that follows a character other
    than white space, so texts may be cut there. Valid while no special string holds a space.
    """

    def __init__(self, model: bytes):
        self.tokenizer = load(model)
        self.first: dict[str, int] = {}  # words at the start of a text, without a leading space
        self.later: dict[str, int] = {}

    def _learn_missing(self, words: set[str], lead: str, known: dict[str, int]) -> None:
        missing = [w for w in words if w not in known]
        if len(known) + len(missing) > CACHE:
            known.clear()
            missing = list(words)
        for at in range(0, len(missing), 4096):
            part = missing[at : at + 4096]
            encoded = self.tokenizer.encode_batch_fast([lead + w for w in part], add_special_tokens=False)
            known.update(zip(part, map(len, encoded)))

    def counts(self, texts: list[str]) -> list[int]:
        split = [_WORD_STARTS.split(t) if _SPACE_AFTER_SPACE.search(t) or t[:1] == " " else t.split(" ") for t in texts]
        heads = {w[0] for w in split}
        self._learn_missing(heads, "", self.first)
        out = []
        for words in split:
            rest = words[1:]
            try:
                total = sum(map(self.later.__getitem__, rest))
            except KeyError:
                self._learn_missing(set(rest), " ", self.later)
                total = sum(map(self.later.__getitem__, rest))
            out.append(self.first[words[0]] + total)
        return out


def chunk_starts(text: str, chunk: int, overlap: int) -> list[tuple[int, int, str]]:
    """(number, byte offset, text) of each chunk; a chunk reaches `overlap` characters back."""
    out, at, offset = [], 0, 0
    for number, cut in enumerate(range(0, max(len(text), 1), chunk)):
        start = max(0, cut - overlap)
        offset += len(text[at:start].encode())
        at = start
        out.append((number, offset, text[start : cut + chunk]))
    return out


def boundaries(tokenizer, lengths: np.ndarray, piece: str) -> tuple[np.ndarray, np.ndarray, int]:
    """Byte offsets of a chunk's pre-token starts, the tokens before each, and all its tokens."""
    encoded = tokenizer.encode(piece, add_special_tokens=False)
    ids = np.asarray(encoded.ids, dtype=np.int64)
    if not len(ids):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    words = np.array([-1 if w is None else w for w in encoded.word_ids], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths[ids])[:-1]])
    first = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]]))
    return starts[first], first, len(ids)


def token_lengths(tokenizer) -> np.ndarray:
    """Bytes of each token: a byte-level vocabulary writes a byte as one character."""
    added = {i: t.content for i, t in tokenizer.get_added_tokens_decoder().items()}
    vocabulary = tokenizer.get_vocab()
    out = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
    for word, i in vocabulary.items():
        out[i] = len(added[i].encode()) if i in added else len(word)
    return out


def count_tokens(
    docs: DataFrame, key: str, text: str, tokenizer_path: str,
    chunk_chars: int = 65_536, overlap_chars: int = 1_024,
) -> DataFrame:
    """Per row of `docs`: the key (as `doc_id`), n_bytes (UTF-8) and n_tokens of the whole text."""
    spark = docs.sparkSession
    model = file_bytes(tokenizer_path)
    if not margin_holds(load(model)):
        raise ValueError("a special string of this vocabulary is longer than the margin allows")
    if any(" " in t.content for t in load(model).get_added_tokens_decoder().values()):
        raise ValueError("a special string of this vocabulary holds a space")
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = WordCounter(shared.value)
        for batch in batches:
            yield pd.Series(counter.counts(batch.tolist()), dtype="int64")

    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    n_bytes = F.octet_length("text").cast("long").alias("n_bytes")
    short = rows.where(F.length("text") <= chunk_chars).select("doc_id", n_bytes, counted("text").alias("n_tokens"))
    # Repeated rows stay apart by their place in the input, which a lost task reproduces.
    huge = rows.withColumn("row", F.monotonically_increasing_id()).where(F.length("text") > chunk_chars)
    return short.unionByName(_spliced(huge, n_bytes, shared, chunk_chars, overlap_chars))


def _spliced(huge: DataFrame, n_bytes, shared, chunk: int, overlap: int) -> DataFrame:
    """The counts of long texts. Each round is written, so only rounds that failed are redone."""
    done, left = [], huge
    while True:
        found = written(_chunked_round(left, n_bytes, shared, chunk, overlap), "token-counts")
        done.append(found.where("whole").select("doc_id", "n_bytes", "n_tokens"))
        failed = found.where("NOT whole").select("row")
        if failed.isEmpty():
            break
        overlap *= WIDER
        left = huge.join(failed, "row", "left_semi")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _chunked_round(huge: DataFrame, n_bytes, shared, chunk: int, overlap: int) -> DataFrame:
    pieces = "array<struct<number:int,offset:long,piece:string>>"
    parts = "struct<tokens:long,head:array<long>,head_before:array<long>,tail:array<long>,tail_before:array<long>>"

    @F.pandas_udf(pieces)
    def cut(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [
            {"number": n, "offset": o, "piece": p} for n, o, p in chunk_starts(t, chunk, overlap)])

    @F.pandas_udf(parts)
    def encoded(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        tokenizer = load(shared.value)
        lengths = token_lengths(tokenizer)
        for offsets, texts in batches:
            out = []
            for offset, piece in zip(offsets, texts):
                at, before, total = boundaries(tokenizer, lengths, piece)
                size = len(piece.encode())
                head_to, tail_from = len(piece[:overlap].encode()), size - len(piece[-overlap:].encode())
                head = at <= head_to
                tail = (at >= tail_from) & (at <= size - MARGIN)
                out.append((total, at[head] + offset, before[head], at[tail] + offset, before[tail]))
            yield pd.DataFrame(out, columns=["tokens", "head", "head_before", "tail", "tail_before"])

    chunks = (
        huge.select("row", "doc_id", n_bytes, F.explode(cut("text")).alias("c"))
        .select("row", "doc_id", "n_bytes", "c.*")
        .repartition("row", "number")
        .select("row", "doc_id", "n_bytes", "number", encoded("offset", "piece").alias("p"))
        .select("row", "doc_id", "n_bytes", "number", "p.*"))
    in_order = Window.partitionBy("row").orderBy("number")
    meet = F.array_min(F.array_intersect("head", "left_tail"))

    def before(spots: str, counts: str):
        return F.element_at(F.col(counts), F.array_position(F.col(spots), F.col("meet")).cast("int"))

    # A chunk adds its tokens from the meeting point on and takes back what its left neighbour
    # counted behind that point.
    return (
        chunks.withColumn("left_tail", F.lag("tail").over(in_order))
        .withColumn("left_before", F.lag("tail_before").over(in_order))
        .withColumn("left_tokens", F.lag("tokens").over(in_order))
        .withColumn("meet", F.when(F.col("number") > 0, meet))
        .withColumn("adds", F.when(F.col("number") == 0, F.col("tokens")).when(
            F.col("meet").isNotNull(),
            F.col("tokens") - before("head", "head_before") + before("left_tail", "left_before") - F.col("left_tokens")))
        .groupBy("row")
        .agg(F.first("doc_id").alias("doc_id"), F.first("n_bytes").alias("n_bytes"),
             F.sum("adds").alias("n_tokens"), F.bool_and(F.col("adds").isNotNull()).alias("whole")))
