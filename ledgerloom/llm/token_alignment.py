"""Alignment of two tokenizers' tokens over the same bytes, by pointer jumping.

Both tokenizations cut the same bytes into tokens. Two tokens are linked if their byte ranges overlap.
Every token points to the token that overlaps it and reaches farthest to the right (itself, if none
reaches farther); successors are doubled, all tokens at once, until each points to the last token of
its connected component. Tokens with the same last token are a group; groups end where a token of
either kind ends.

A (byte-level BPE) reads a space and the text, B (byte-fallback BPE) the text, before which it puts
a space itself. Both start anew at a space that follows a character other than white space or the
space mark, so texts are aligned word by word, words not met before all at once, and remembered.
Texts with a word whose tokens' bytes are not the word's (say, a space mark, which B reads as a space)
are judged as a whole: they have no tokens unless both joined byte strings are the text's.

How often an id pair is linked is counted over the whole corpus. Documents come in blocks of bounded
bytes: a task counts a block's pairs, Spark sums the blocks' pairs, and the sums of just its own pairs
come back to each block, whose documents then look up theirs. Nothing as large as the vocabulary's
pairs is ever broadcast.

Defined cases: null and empty texts, and those that do not match, have zeros and an empty string as
digest; repeated rows and null ids each keep their own row; an empty frame gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import file_bytes, written

MARK = "▁"
CACHE = 400_000       # words that a task remembers between blocks; it bounds memory, not the result
PAIRS = 4_000_000     # id pairs that a task numbers before it begins anew, likewise
BLOCK_BYTES = 1 << 23  # text of a block, unless one document is longer
BATCH = 64            # documents aligned together

_NOT_PLAIN = re.compile(f"[\\s᠎{MARK}] ")
_WORD_STARTS = re.compile(f"(?<=[^\\s᠎{MARK}]) ")


# -- pointer jumping --------------------------------------------------------------------------------

def last_tokens(starts: np.ndarray, ends: np.ndarray, is_b: np.ndarray) -> np.ndarray:
    """For each token, the last token of its connected component of overlapping tokens.

    Tokens of each kind are in order and do not overlap one another; none is empty. Of two tokens that
    end alike, A's counts as the farther one.
    """
    successor = np.arange(len(starts))
    a, b = np.flatnonzero(~is_b), np.flatnonzero(is_b)
    for own, other, wins in ((a, b, False), (b, a, True)):
        if not len(own) or not len(other):
            continue
        # the farthest token of the other kind that begins before this one ends
        at = np.searchsorted(starts[other], ends[own], side="left") - 1
        far = other[np.maximum(at, 0)]
        overlaps = (at >= 0) & (ends[far] > starts[own])
        farther = (ends[far] >= ends[own]) if wins else (ends[far] > ends[own])
        successor[own] = np.where(overlaps & farther, far, own)
    while True:
        doubled = successor[successor]
        if (doubled == successor).all():
            return successor
        successor = doubled


def overlaps(a_starts: np.ndarray, a_ends: np.ndarray, b_starts: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (A, B) pairs of places whose ranges overlap, in order."""
    first = np.searchsorted(b_ends, a_starts, side="right")
    counts = np.searchsorted(b_starts, a_ends, side="left") - first
    a = np.repeat(np.arange(len(a_starts)), counts)
    return a, np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(first, counts)


# -- tokenizers -------------------------------------------------------------------------------------

def byte_characters() -> dict[str, int]:
    """The characters in which a byte-level vocabulary writes bytes: printable ones stand for
    themselves, the others, in order, for the characters from 256 on."""
    kept = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in kept]
    return {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(rest)}


class Pair:
    """The two tokenizers and, for each of their ids, the token's bytes."""

    def __init__(self, a_model: bytes, b_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_buffer(a_model)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        bytes_of, vocabulary = byte_characters(), self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(bytes_of[c] for c in token) if all(c in bytes_of for c in token) else token.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces):
            raise ValueError("this vocabulary cannot be encoded word by word")
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        self.lone = self.b.encode("a ")[len(self.b.encode("a")) :]  # a space that ends a text

    def ids(self, words: list[str], whole: bool) -> list[tuple[list[int], list[int]]]:
        """A's and B's ids of a space and each word; an empty word is a space behind another word."""
        a = [e.ids for e in self.a.encode_batch_fast([" " + w for w in words], add_special_tokens=False)]
        b = self.b.encode(words, num_threads=1)
        return [(x, y if w or whole else self.lone) for w, x, y in zip(words, a, b)]

    def matches(self, text: str, a: list[int], b: list[int]) -> bool:
        want = b" " + text.encode()
        return b"".join(map(self.a_bytes.__getitem__, a)) == want == b"".join(map(self.b_bytes.__getitem__, b))


class Aligner:
    """Groups and links of texts; remembers words, and numbers the id pairs it meets."""

    def __init__(self, a_model: bytes, b_model: bytes):
        self.pair = Pair(a_model, b_model)
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in t], dtype=np.int64) for t in (self.pair.a_bytes, self.pair.b_bytes))
        self.forget()

    def forget(self) -> None:
        self.row: dict[str, int] = {}
        self.texts: list[str] = []       # a word's groups as text
        self.facts = np.zeros((0, 4), dtype=np.int64)  # A tokens, B tokens, groups, links; all -1 if it does not match
        self.uses = np.zeros(0, dtype=np.int64)
        self.starts = np.zeros(0, dtype=np.int64)      # where its links begin in `flat`
        self.flat = np.zeros(0, dtype=np.int32)        # links as numbers of id pairs
        self.pairs = np.zeros(0, dtype=np.int64)       # the id pairs by number, A's id * 2**32 + B's
        self.number: dict[int, int] = {}

    def trim(self) -> None:
        """Keeps the words met most often, half as many as may be remembered, if there are too many."""
        if len(self.pairs) > PAIRS:
            self.forget()
        if len(self.texts) <= CACHE:
            return
        kept = np.sort(np.argsort(-self.uses, kind="stable")[: CACHE // 2])
        links = np.maximum(self.facts[kept, 3], 0)
        ends = np.cumsum(links)
        self.flat = self.flat[np.repeat(self.starts[kept] - ends + links, links) + np.arange(links.sum())]
        self.starts, self.facts, self.uses = ends - links, self.facts[kept], self.uses[kept] // 2
        words = list(self.row)  # in the order of their places
        self.row = {words[i]: n for n, i in enumerate(kept.tolist())}
        self.texts = [self.texts[i] for i in kept.tolist()]

    def learn(self, words: list[str], whole: bool = False) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Group texts, facts and pair codes (one after the other) of words, aligned all at once."""
        ids = self.pair.ids(words, whole)
        fits = [self.pair.matches(w, a, b) for w, (a, b) in zip(words, ids)]
        kept = [(a, b) if ok else ([], []) for ok, (a, b) in zip(fits, ids)]
        n_a, n_b = (np.array([len(k[i]) for k in kept], dtype=np.int64) for i in (0, 1))
        a_ids, b_ids = (np.fromiter(itertools.chain.from_iterable(k[i] for k in kept), np.int64) for i in (0, 1))
        # the words lie end to end, so tokens of two words never overlap
        a_ends, b_ends = np.cumsum(self.a_sizes[a_ids]), np.cumsum(self.b_sizes[b_ids])
        a_starts, b_starts = a_ends - self.a_sizes[a_ids], b_ends - self.b_sizes[b_ids]
        last = last_tokens(np.concatenate([a_starts, b_starts]), np.concatenate([a_ends, b_ends]), np.arange(len(a_ids) + len(b_ids)) >= len(a_ids))
        a_groups, b_groups = last[: len(a_ids)], last[len(a_ids) :]
        at, to = overlaps(a_starts, a_ends, b_starts, b_ends)
        word_of_a = np.repeat(np.arange(len(words)), n_a)
        first_of_group = np.concatenate([[True], a_groups[1:] != a_groups[:-1]])[: len(a_ids)]
        facts = np.stack([n_a, n_b, np.bincount(word_of_a[first_of_group], minlength=len(words)), np.bincount(word_of_a[at], minlength=len(words))], axis=1)
        facts[~np.array(fits, dtype=bool)] = -1
        return self.group_texts(len(words), n_a, a_ids, b_ids, a_groups, b_groups), facts, (a_ids[at] << 32) | b_ids[to]

    @staticmethod
    def group_texts(words, n_a, a_ids, b_ids, a_groups, b_groups) -> list[str]:
        """Per word: its groups as `a1,a2|b1;a3|b2,b3`."""
        if not len(a_ids):
            return [""] * words
        a_cuts = np.flatnonzero(np.concatenate([[True], a_groups[1:] != a_groups[:-1], [True]]))
        b_cuts = np.flatnonzero(np.concatenate([[True], b_groups[1:] != b_groups[:-1], [True]]))
        a_text, b_text = list(map(str, a_ids.tolist())), list(map(str, b_ids.tolist()))
        groups = [",".join(a_text[a:z]) + "|" + ",".join(b_text[b:y])
                  for a, z, b, y in zip(a_cuts[:-1].tolist(), a_cuts[1:].tolist(), b_cuts[:-1].tolist(), b_cuts[1:].tolist())]
        ends = np.searchsorted(a_cuts, np.cumsum(n_a)).tolist()
        return [";".join(groups[a:z]) for a, z in zip([0, *ends], ends)]

    def numbers(self, codes: np.ndarray) -> np.ndarray:
        """Numbers of id pairs; new ones get the next number."""
        distinct, back = np.unique(codes, return_inverse=True)
        known, fresh = self.number, []
        for code in distinct.tolist():
            if code not in known:
                known[code] = len(known)
                fresh.append(code)
        self.pairs = np.concatenate([self.pairs, np.array(fresh, dtype=np.int64)])
        return np.fromiter(map(known.__getitem__, distinct.tolist()), np.int32, len(distinct))[back]

    def rows(self, words: list[str]) -> np.ndarray:
        """The words' places; those not met before are learned together."""
        found = np.fromiter(map(self.row.get, words, itertools.repeat(-1)), np.int64, len(words))
        unmet = np.flatnonzero(found < 0).tolist()
        if unmet:
            new = list(dict.fromkeys(words[i] for i in unmet))
            texts, facts, codes = self.learn(new)
            links = np.maximum(facts[:, 3], 0)
            self.row.update(zip(new, range(len(self.texts), len(self.texts) + len(new))))
            self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(links) - links])
            self.texts += texts
            self.uses = np.concatenate([self.uses, np.zeros(len(new), dtype=np.int64)])
            self.facts = np.concatenate([self.facts, facts])
            self.flat = np.concatenate([self.flat, self.numbers(codes)])
            found[unmet] = [self.row[words[i]] for i in unmet]
        self.uses += np.bincount(found, minlength=len(self.texts))
        return found

    def align(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, str, np.ndarray]]:
        """Per text: its facts (A tokens, B tokens, groups, links), groups as text and links as pair numbers."""
        split = [[] if not t else _WORD_STARTS.split(t) if t[0] == " " or _NOT_PLAIN.search(t) else t.split(" ") for t in texts]
        rows = self.rows(list(itertools.chain.from_iterable(split)))
        none = np.zeros(4, dtype=np.int64), "", np.zeros(0, dtype=np.int32)
        for text, own in zip(texts, np.split(rows, np.cumsum([len(s) for s in split])[:-1]) if texts else []):
            if not text:
                yield none
                continue
            facts = self.facts[own]
            if (facts < 0).any():
                groups, facts, codes = self.learn([text], whole=True)
                yield none if facts[0, 0] < 0 else (facts[0], groups[0], self.numbers(codes))
                continue
            counts = facts[:, 3]
            ends = np.cumsum(counts)
            places = np.repeat(self.starts[own] - ends + counts, counts) + np.arange(ends[-1])
            yield facts.sum(axis=0), ";".join(map(self.texts.__getitem__, own.tolist())), self.flat[places]


# -- the operator -----------------------------------------------------------------------------------

def blocks(docs: DataFrame, key: str, text: str, a_path: str, b_path: str) -> DataFrame:
    """One pass over the texts, two kinds of rows: per document its facts and its links' pairs (as
    numbers within the block, with how often), and per block (no digest) the pairs and their counts."""
    models = docs.sparkSession.sparkContext.broadcast((file_bytes(a_path), file_bytes(b_path)))
    columns = ["block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]

    def aligned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        aligner, block, size, totals = Aligner(*models.value), 0, 0, np.zeros(0, dtype=np.int64)

        def closed() -> pd.DataFrame:
            used = np.flatnonzero(totals)
            return pd.DataFrame([(block, None, 0, 0, 0, 0, None, pairs_of(aligner.pairs[used], used), totals[used].tobytes())], columns=columns)

        def pairs_of(codes: np.ndarray, numbers: np.ndarray) -> bytes:
            return np.stack([codes, numbers]).tobytes()

        for batch in batches:
            for at in range(0, len(batch), BATCH):
                part = batch.iloc[at : at + BATCH]
                if size > BLOCK_BYTES:
                    yield closed()
                    block, size = block + 1, 0
                    aligner.trim()
                    totals = np.zeros(len(aligner.pairs), dtype=np.int64)
                out = []
                for doc_id, value, (facts, groups, links) in zip(part["doc_id"], part["text"], aligner.align(part["text"].tolist())):
                    if len(aligner.pairs) > len(totals):
                        totals = np.concatenate([totals, np.zeros(2 * len(aligner.pairs) - len(totals), dtype=np.int64)])
                    numbers, times = np.unique(links, return_counts=True)
                    totals[numbers] += times
                    size += len(value or "")
                    mark = hashlib.sha256(groups.encode()).hexdigest() if facts[0] else ""
                    out.append((block, doc_id, *facts.tolist(), mark, numbers.astype(np.int32).tobytes(), times.astype(np.int32).tobytes()))
                yield pd.DataFrame(out, columns=columns)
        if size:
            yield closed()

    # ids go through pandas as text, which keeps long ones exact beside nulls
    rows = docs.select(F.col(key).cast("string").alias("doc_id"), F.col(text).alias("text"))
    found = rows.mapInPandas(
        aligned, "block long, doc_id string, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary")
    # a block is one task's; its number is made unique by the task's
    return found.withColumn("block", F.shiftleft(F.spark_partition_id().cast("long"), 32) + F.col("block"))


def block_pairs(closed: DataFrame) -> DataFrame:
    """(block, number, a, b, times) of every pair of every block."""
    def opened(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block, pairs, times in zip(batch["block"], batch["pairs"], batch["times"]):
                codes, numbers = np.frombuffer(pairs, dtype=np.int64).reshape(2, -1)
                yield pd.DataFrame({"block": block, "number": numbers, "a": codes >> 32, "b": codes & 0xFFFFFFFF,
                                    "times": np.frombuffer(times, dtype=np.int64)})

    return closed.select("block", "pairs", "times").mapInPandas(opened, "block long, number long, a long, b long, times long")


def pair_counts(pairs: DataFrame) -> DataFrame:
    """Corpus-wide: (a, b, count, best); best are the pairs with the highest count of their B id."""
    sums = written(pairs.groupBy("a", "b").agg(F.sum("times").alias("count")), "pair-counts")
    most = sums.groupBy("b").agg(F.max("count").alias("most"))
    return sums.join(most, "b").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


def align(docs: DataFrame, key: str, text: str, a_path: str, b_path: str) -> DataFrame:
    """Per row of `docs`: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    found = written(blocks(docs, key, text, a_path, b_path), "aligned")
    pairs = block_pairs(found.where("groups_sha256 IS NULL"))
    counted = pairs.join(pair_counts(pairs), ["a", "b"]).groupBy("block").agg(
        F.collect_list(F.struct("number", "count", "best")).alias("known"))  # at most a block's pairs
    known = written(counted.select("block", "known.number", "known.count", "known.best"), "block-counts")
    texts = found.where("groups_sha256 IS NOT NULL")

    def summed(rows: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        best = count = np.zeros(0, dtype=np.int64)
        if len(held) and len(held["number"].iloc[0]):
            number = np.asarray(held["number"].iloc[0], dtype=np.int64)
            best, count = np.zeros(number.max() + 1, dtype=np.int64), np.zeros(number.max() + 1, dtype=np.int64)
            best[number], count[number] = np.asarray(held["best"].iloc[0]), np.asarray(held["count"].iloc[0])
        links = [(np.frombuffer(p, dtype=np.int32), np.frombuffer(t, dtype=np.int32)) for p, t in zip(rows["pairs"], rows["times"])]
        return rows[["doc_id", "n_a", "n_b", "n_groups", "n_links"]].assign(
            n_best=[int(best[p] @ t) for p, t in links], count_sum=[int(count[p] @ t) for p, t in links],
            groups_sha256=rows["groups_sha256"])

    schema = "doc_id string, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    out = texts.groupBy("block").cogroup(known.groupBy("block")).applyInPandas(summed, schema)
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))
