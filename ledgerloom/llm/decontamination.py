"""Benchmark decontamination by latent semantic retrieval.

Words are runs of letters, digits and underscores of lower-cased text, known by a 64-bit hash.
Benchmark items are cut into passages of at most `PASSAGE` words, and these into groups of at most
`GROUP`. Each group has a latent space: the leading directions of a matrix of TF-IDF passages, its
own and those of all documents (at less weight, together that of `CORPUS_PASSAGES`), over the words of
its passages. A randomised SVD finds them: the matrix, transposed, times itself is multiplied with a random
block and the product made orthonormal, a few times over. Of up to `GRAM_WORDS` words tasks add up that
square once, in one pass over the passages; with more, too large a square, they multiply their passages with
the block each time. Document frequencies are counted over all documents. Texts are hashed once for all of it.

Every document is cut into segments of `SEGMENT` words; windows of neighbouring segments, as wide as
a passage needs, are projected and compared with the passages by cosine. Text beside a passage lowers
the cosine of its window, so a window is a candidate too if its product with the passage is as large
as that of any window with `LCS_SHARE` of the passage's words must be. A candidate is confirmed by
the longest common subsequence of the passage and the window with its surroundings (`LCS_SHARE` of
the passage), and by its answer, the passage's last sentence: unless nearly all of the passage is
there (`WHOLE_SHARE`), `ANSWER_SHARE` of the answer must be. Passages of fewer than `SHORT` words
must be there entirely.

Defined cases: null and blank texts hold nothing; null or blank benchmark items are nowhere; an
empty benchmark finds nothing; null ids and repeated rows are examined like any other; a document
that holds an item several times has it once, with the best match; other columns are ignored.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import written

PASSAGE = 64
GROUP = 256
SPACES = 8              # latent spaces used in one pass over the documents
EXTRA = 24              # directions beyond the number of passages
POWER_ROUNDS = 3
CORPUS_PASSAGES = 4096  # all corpus passages together weigh as much as so many
CORPUS_TASKS = 4
CORPUS_ROWS = 1024      # corpus passages multiplied at once
CORPUS_WEIGHT = 0.1
GRAM_WORDS = 6144       # the half square of so many words is 75 MB
SEGMENT = 16
COSINE = 0.6
LEAST_NORM = 0.4        # of the weakest passage's, below which a window cannot hold 60 % of a passage
LCS_SHARE, WHOLE_SHARE, ANSWER_SHARE = 0.6, 0.85, 0.5
SHORT = 8
AROUND = 12             # words on both sides of a window that the common subsequence may use
BLOB = 1 << 17          # bytes of text handled at once

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*b"abcdefghijklmnopqrstuvwxyz0123456789_"]] = True
_LETTER[128:] = True
_VALUES = np.array([pow(0xD1342543DE82EF95, k + 2, 1 << 64) | 1 for k in range(256)], dtype=np.uint64)
_VALUES[~_LETTER] = 0
_BASE = 0x9E3779B97F4A7C15


@functools.lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the base from the first on, and those of its inverse from the zeroth on."""
    return tuple(np.cumprod(np.r_[np.uint64(first), np.full(size - 1, by, dtype=np.uint64)], dtype=np.uint64)
                 for first, by in ((_BASE, _BASE), (1, pow(_BASE, -1, 1 << 64))))


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word of lower-cased UTF-8: the sum of its letters' values times rising powers,
    by the place in the data, which the inverse power of the word's start moves to the place in the word."""
    a = np.frombuffer(data, np.uint8)
    inside = _LETTER[a]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1 if len(a) else np.zeros(0, np.int64)
    edges = np.concatenate([[0], edges] if len(a) and inside[0] else [edges])
    if len(edges) % 2:
        edges = np.append(edges, len(a))
    starts = edges[::2]
    if not len(starts):
        return starts.astype(np.int64), np.zeros(0, np.uint64)
    powers, inverse = _powers(max(2 * BLOB, 1 << (len(a) - 1).bit_length()))
    h = np.add.reduceat(_VALUES[a] * powers[: len(a)], starts) * inverse[starts]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return starts, h ^ (h >> np.uint64(32))


def hashed(texts: list[str | None]) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Word hashes of many texts, some at a time: (their places, their hashes)."""
    held, size, places = [], 0, []
    for place, text in enumerate([*texts, None]):
        if place < len(texts):
            held.append((text or "").lower().encode())
            places.append(place)
            size += len(held[-1]) + 1
        if held and (size > BLOB or place == len(texts)):
            starts, hashes = word_hashes(b"\n".join(held))
            cuts = np.searchsorted(starts, np.cumsum([len(h) + 1 for h in held])[:-1])
            yield places, np.split(hashes, cuts)
            held, size, places = [], 0, []


class Vocabulary:
    """Word hash to index, -1 if unknown, by a table of the hash's low bits."""

    def __init__(self, words: np.ndarray):
        self.words = words
        bits = max(16, int(len(words) * 16).bit_length())
        self.mask = np.uint64((1 << bits) - 1)
        self.slots = np.full(1 << bits, -1, dtype=np.int32)
        low = (words & self.mask).astype(np.int64)
        self.slots[low] = np.arange(len(words))  # the last of those that share a slot
        self.clash = {int(w): i for i, w in enumerate(words) if self.slots[low[i]] != i}
        self.clashing = np.array(sorted(self.clash), dtype=np.uint64)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        found = self.slots[(hashes & self.mask).astype(np.int64)]
        found = np.where((found >= 0) & (self.words[found] == hashes), found, -1)
        if len(self.clashing):
            for at in np.flatnonzero(np.isin(hashes, self.clashing)).tolist():
                found[at] = self.clash[int(hashes[at])]
        return found


def passages(items: list[tuple[int, str]]) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(item, word hashes, word hashes of the answer) of each passage of the items."""
    out = []
    for item, text in items:
        sentences = [s for s in re.split(r"(?<=[.!?])\s+|\n+", text or "") if s.strip()]
        words = next(hashed([text]))[1][0]
        for at in range(0, len(words), PASSAGE):
            part = words[at : at + PASSAGE]
            if at and len(part) < PASSAGE // 2:
                part = words[-PASSAGE:]
            last = next(hashed([sentences[-1]]))[1][0] if at + PASSAGE >= len(words) else part[-SHORT:]
            out.append((item, part, last if len(last) else part))
    return out


def _weights(index: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """The TF-IDF vector, of length one, of a passage of known words."""
    v = np.bincount(index[index >= 0], minlength=len(idf)) * idf
    return v / max(np.linalg.norm(v), 1e-12)


def document_frequencies(corpus: DataFrame, words: int) -> tuple[np.ndarray, int]:
    """In how many documents each of the words stands, and how many documents have any word."""
    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = np.zeros(words + 1, dtype=np.int64)
        for batch in batches:
            index = np.frombuffer(b"".join(batch["words"]), dtype=np.int32).astype(np.int64)
            owner = np.repeat(np.arange(len(batch)), [len(w) // 4 for w in batch["words"]])
            n += np.bincount(np.unique(owner * len(n) + index) % len(n), minlength=len(n))
            n[-1] += len(batch)
        some = np.flatnonzero(n)
        yield pd.DataFrame({"word": some, "n": n[some]})

    rows = corpus.mapInPandas(counted, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(words + 1, dtype=np.int64)
    for r in rows:  # at most one per word
        out[r["word"]] = r["n"]
    return out[:-1], int(out[-1])


def _corpus(docs: DataFrame, text: str, words: np.ndarray) -> DataFrame:
    """Every text that has a word, cut into passages of PASSAGE words, written: the index of each word that is
    one of `words`, and how many of them each passage has. Passages without one are left out; they weigh nothing."""
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary = Vocabulary(shared.value)
        for batch in batches:
            out = []
            for _, parts in hashed(batch["text"].tolist()):
                parts = [p for p in parts if len(p)]
                if not parts:
                    continue
                sizes = np.array([len(p) for p in parts])
                index = vocabulary(np.concatenate(parts)).astype(np.int32)
                kept = np.flatnonzero(index >= 0)
                ends, cuts = np.cumsum(sizes), np.cumsum(-(-sizes // PASSAGE))
                owner = np.searchsorted(ends, kept, side="right")
                place = kept - (ends - sizes)[owner]
                passage = np.r_[0, cuts[:-1]][owner] + place // PASSAGE
                known = np.bincount(passage, minlength=cuts[-1]).astype(np.int32)
                held = np.split(known, cuts[:-1])
                out += [(w.tobytes(), p[p > 0].tobytes()) for w, p in zip(np.split(index[kept], np.searchsorted(kept, ends[:-1])), held)]
            yield pd.DataFrame(out, columns=["words", "passages"])

    # dealt evenly: each round multiplies all of it, however few files the documents lie in
    rows = docs.select(F.col(text).alias("text")).mapInPandas(cut, "words binary, passages binary")
    return written(rows.repartition(docs.sparkSession.sparkContext.defaultParallelism), "corpus-passages")


def _rows(batch: pd.DataFrame, place: np.ndarray, idf: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """The TF-IDF rows of a batch's passages, some at a time: (row, word and weight of each cell, by row and
    word; the first cell of each row)."""
    index = place[np.frombuffer(b"".join(batch["words"]), dtype=np.int32)]
    counts = np.frombuffer(b"".join(batch["passages"]), dtype=np.int32)
    cuts = np.cumsum(counts)
    for at in range(0, len(counts), CORPUS_ROWS):
        some = counts[at : at + CORPUS_ROWS]
        own = index[cuts[at] - counts[at] : cuts[at + len(some) - 1]]
        codes, times = np.unique((np.repeat(np.arange(len(some)), some) * len(idf) + own)[own >= 0], return_counts=True)
        if not len(codes):
            continue
        row, word = np.divmod(codes, len(idf))
        weight = times * idf[word]
        starts = np.flatnonzero(np.diff(row, prepend=-1))
        row = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(row)))
        yield row, word, (weight / np.maximum(np.sqrt(np.add.reduceat(weight ** 2, starts)), 1e-12)[row]).astype(np.float32), starts


def _products(batch: pd.DataFrame, place: np.ndarray, idf: np.ndarray, block: np.ndarray, total: np.ndarray) -> None:
    """Adds to `total` the TF-IDF rows of a batch's passages, transposed, times the rows times `block`."""
    for row, word, weight, starts in _rows(batch, place, idf):
        rows = np.add.reduceat(block[word] * weight[:, None], starts)
        order = np.argsort(word, kind="stable")
        firsts = np.flatnonzero(np.diff(word[order], prepend=-1))
        total[word[order][firsts]] += np.add.reduceat(rows[row[order]] * weight[order][:, None], firsts)


def _squares(batch: pd.DataFrame, place: np.ndarray, idf: np.ndarray, total: np.ndarray) -> None:
    """Adds to `total`, an upper triangle row after row, the TF-IDF rows of a batch's passages, transposed, times the rows."""
    line = _lines(len(idf)).astype(np.int32)
    for row, word, weight, starts in _rows(batch, place, idf):
        word = word.astype(np.int32)
        at = np.arange(len(word), dtype=np.int32)
        times = np.append(starts[1:], len(word)).astype(np.int32)[row] - at  # a cell meets itself and those after it
        other = np.arange(times.sum(), dtype=np.int32) - np.repeat(np.cumsum(times, dtype=np.int32) - times - at, times)
        np.add.at(total, np.repeat(line[word], times) + word[other], np.repeat(weight, times) * weight[other])


def _lines(size: int) -> np.ndarray:
    """Where in an upper triangle, row after row, each row's column 0 would be."""
    at = np.arange(size, dtype=np.int64)
    return at * (2 * size - at - 1) // 2


def _square(corpus: DataFrame, place: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """The TF-IDF rows of all corpus passages, transposed, times the rows."""
    known, size = corpus.sparkSession.sparkContext.broadcast((place, idf)), len(idf)
    half = size * (size + 1) // 2

    def squared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(half, dtype=np.float32)
        for batch in batches:
            _squares(batch, *known.value, total)
        for k, part in enumerate(np.array_split(total, CORPUS_TASKS)):
            yield pd.DataFrame({"slice": [k], "product": [part.tobytes()]})

    out, lines = np.zeros((size, size), dtype=np.float32), _lines(size)
    parts = {r["slice"]: r["product"] for r in corpus.mapInPandas(squared, "slice long, product binary")
             .repartition(CORPUS_TASKS, "slice").mapInPandas(_added, "slice long, product binary").collect()}  # one triangle in all
    total = np.frombuffer(b"".join(parts[k] for k in sorted(parts)), dtype=np.float32)
    if len(total):
        for i in range(size):
            out[i, i:] = out[i:, i] = total[lines[i] + i : lines[i] + size]
    return out


def _added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The sum of the arrays of each slice."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, part in zip(batch["slice"].tolist(), batch["product"]):
            sums[k] = sums.get(k, 0) + np.frombuffer(part, dtype=np.float32)
    yield pd.DataFrame({"slice": list(sums), "product": [v.astype(np.float32).tobytes() for v in sums.values()]})


def _basis(corpus: DataFrame, weight: float, own: np.ndarray, place: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Leading directions of own and corpus passages by subspace iteration from a random block; `place` is
    the index of each word of the corpus among the group's words, -1 if it is none of them."""
    context = corpus.sparkSession.sparkContext
    known, size = context.broadcast((place, idf)), len(idf)

    def multiplied(block):
        def product(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            place_, idf_ = known.value
            total = np.zeros(block.value.shape, dtype=np.float32)
            for batch in batches:
                _products(batch, place_, idf_, block.value, total)
            yield pd.DataFrame({"slice": range(CORPUS_TASKS), "product": [total[k::CORPUS_TASKS].tobytes() for k in range(CORPUS_TASKS)]})
        return product

    rank = min(len(own) + EXTRA, size)
    block = np.random.default_rng(0).standard_normal((size, rank)).astype(np.float32)
    square = _square(corpus, place, idf) if size <= GRAM_WORDS else None
    for _ in range(POWER_ROUNDS):
        if square is not None:
            block = np.linalg.qr(own.T @ (own @ block) + weight * (square @ block))[0].astype(np.float32)
            continue
        parts = corpus.mapInPandas(multiplied(context.broadcast(block)), "slice long, product binary")
        total = own.T @ (own @ block)
        for r in parts.repartition(CORPUS_TASKS, "slice").mapInPandas(_added, "slice long, product binary").collect():  # one block in all
            total[r["slice"]::CORPUS_TASKS] += weight * np.frombuffer(r["product"], dtype=np.float32).reshape(-1, rank)
        block = np.linalg.qr(total)[0].astype(np.float32)
    return block


def build(docs: DataFrame, text: str, benchmark: DataFrame, key: str, item_text: str) -> list[dict]:
    """The latent spaces of all benchmark passages, as plain arrays."""
    items = [(r[0], r[1]) for r in benchmark.select(key, item_text).where(F.col(item_text).isNotNull()).toLocalIterator()]
    all_passages = passages(sorted(items, key=lambda i: (i[0] is None, i[0], i[1])))
    if not all_passages:
        return []
    words = np.unique(np.concatenate([p[1] for p in all_passages]))
    corpus = _corpus(docs, text, words)
    frequency, n = document_frequencies(corpus, len(words))
    idf = np.log((n + 1) / (frequency + 1)) + 1e-3
    passages_ = corpus.agg(F.sum(F.octet_length("passages"))).first()[0] or 0
    weight = CORPUS_WEIGHT ** 2 * min(1.0, CORPUS_PASSAGES * 4 / max(passages_, 1))  # four bytes a passage
    spaces = []
    for at in range(0, len(all_passages), GROUP):
        group = all_passages[at : at + GROUP]
        own_words = np.unique(np.concatenate([p[1] for p in group]))
        own_idf = idf[np.searchsorted(words, own_words)]
        vocabulary = Vocabulary(own_words)
        vectors = np.array([_weights(vocabulary(p[1]), own_idf) for p in group], dtype=np.float32)
        place = np.full(len(words), -1, dtype=np.int64)
        place[np.searchsorted(words, own_words)] = np.arange(len(own_words))
        basis = _basis(corpus, weight, vectors, place, own_idf)
        spaces.append({
            "words": own_words, "idf": own_idf, "rows": (own_idf[:, None] * basis).astype(np.float32),
            "items": [p[0] for p in group], "passages": [p[1] for p in group], "answers": [p[2] for p in group]})
    return spaces


def common_subsequence(masks: dict[int, int], size: int, words: list[int]) -> int:
    """Length of the longest common subsequence of a passage, given as bit masks of its words, and `words`."""
    full = (1 << size) - 1
    row = full
    for w in words:
        hit = row & masks.get(w, 0)
        row = (row + hit | row - hit) & full
    return size - row.bit_count()


def _masks(words: np.ndarray) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, w in enumerate(words.tolist()):
        out[w] = out.get(w, 0) | 1 << i
    return out


class Space:
    """One group of passages, ready for search."""

    def __init__(self, arrays: dict):
        self.items, self.rows = arrays["items"], arrays["rows"]
        self.vocabulary = Vocabulary(arrays["words"])
        self.sizes = [len(p) for p in arrays["passages"]]
        self.masks = [_masks(p) for p in arrays["passages"]]
        self.answers = [(_masks(a), len(a)) for a in arrays["answers"]]
        latent = np.array([self.rows[self.vocabulary(p)].sum(axis=0) for p in arrays["passages"]])
        norms = np.linalg.norm(latent, axis=1)
        latent /= np.maximum(norms, 1e-12)[:, None]
        products = np.array([self._least_product(arrays["idf"], self.vocabulary(p)) for p in arrays["passages"]]) / np.maximum(norms, 1e-12)
        # a passage of n words, wherever it begins, lies in ceil(n / SEGMENT) + 1 segments
        width = np.array([-(-n // SEGMENT) + 1 for n in self.sizes])
        self.widths = [(int(w), np.flatnonzero(width == w), latent[width == w], LEAST_NORM * norms[width == w].min(), products[width == w])
                       for w in np.unique(width)]

    @staticmethod
    def _least_product(idf: np.ndarray, index: np.ndarray) -> float:
        """The least product of a passage with a window that holds LCS_SHARE of its words, whichever, with room for rounding."""
        each = np.sort(idf[index] ** 2 * np.bincount(index, minlength=len(idf))[index])
        share = LCS_SHARE if len(index) >= SHORT else 1
        return 0.98 * float(each[: int(np.ceil(share * len(index) - 1e-9))].sum())

    def search(self, parts: list[np.ndarray]) -> dict[int, dict]:
        """Place of a text -> item -> (cosine, share of the passage, share of the answer) of its best match."""
        words = np.concatenate(parts)
        found: dict[int, dict] = {}
        if not len(words):
            return found
        counts = np.array([len(p) for p in parts])
        text_start = np.cumsum(counts) - counts
        segments = -(-counts // SEGMENT)
        owner = np.repeat(np.arange(len(parts)), segments)
        first_segment = np.cumsum(segments) - segments
        number = np.arange(len(owner)) - first_segment[owner]
        begins = text_start[owner] + number * SEGMENT
        last = (first_segment + segments)[owner]
        index = self.vocabulary(words)
        kept = np.flatnonzero(index >= 0)
        if not len(kept):
            return found
        sums = self._summed(index[kept], np.searchsorted(kept, begins))
        place = np.arange(len(owner))
        for width, passages_, latent, least, products in self.widths:
            starts = place[(number == 0) | (place + width <= last)]
            window = sums[starts]
            for k in range(1, width):
                inside = starts + k < last[starts]
                window[inside] += sums[starts[inside] + k]
            norm = np.linalg.norm(window, axis=1)
            product = window @ latent.T
            cosine = product / np.maximum(norm, 1e-12)[:, None]
            for i, j in np.argwhere((cosine >= COSINE) & (norm >= least)[:, None] | (product >= products)):
                text, passage = int(owner[starts[i]]), int(passages_[j])
                shares = self._shares(passage, parts[text], int(number[starts[i]]) * SEGMENT, width * SEGMENT)
                if shares:
                    match = (float(cosine[i, j]), *shares)
                    of_text = found.setdefault(text, {})
                    item = self.items[passage]
                    of_text[item] = max(of_text.get(item, match), match, key=lambda m: (m[1], m[2], m[0]))
        return found

    def _summed(self, index: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """The summed rows of each segment's words: first words of all segments, then second ones ..."""
        counts = np.append(begins[1:], len(index)) - begins
        order = np.argsort(-counts, kind="stable")
        begins, counts = begins[order], counts[order]
        sums = np.zeros((len(begins), self.rows.shape[1]), dtype=np.float32)
        for k in range(int(counts[0])):
            some = int(np.searchsorted(-counts, -k))
            sums[:some] += self.rows[index[begins[:some] + k]]
        out = np.empty_like(sums)
        out[order] = sums
        return out

    def _shares(self, passage: int, words: np.ndarray, at: int, size: int) -> tuple[float, float] | None:
        region = words[max(0, at - AROUND) : at + size + AROUND].tolist()
        n = self.sizes[passage]
        share = common_subsequence(self.masks[passage], n, region) / n
        if share < (LCS_SHARE if n >= SHORT else 1):
            return None
        masks, length = self.answers[passage]
        answer = common_subsequence(masks, length, region) / length
        return (share, answer) if share >= WHOLE_SHARE or answer >= ANSWER_SHARE else None


def leaks(docs: DataFrame, spaces: list[dict], text: Column) -> Column:
    """A column array<struct<item_id, cosine, lcs, answer>> of the benchmark items that a text holds."""
    kind = "array<struct<item_id:long,cosine:double,lcs:double,answer:double>>"

    def searched(some: list[dict]) -> Column:
        shared = docs.sparkSession.sparkContext.broadcast(some)

        @F.pandas_udf(kind)
        def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            own = [Space(s) for s in shared.value]
            for batch in batches:
                out: list[dict] = [{} for _ in range(len(batch))]
                for places, parts in hashed(batch.tolist()):
                    for space in own:
                        for text_, items in space.search(parts).items():
                            for item, match in items.items():
                                held = out[places[text_]]
                                held[item] = max(held.get(item, match), match, key=lambda m: (m[1], m[2], m[0]))
                yield pd.Series([[{"item_id": i, "cosine": m[0], "lcs": m[1], "answer": m[2]} for i, m in sorted(o.items(), key=lambda x: (x[0] is None, x[0]))] for o in out])

        return found(F.coalesce(text, F.lit("")))

    groups = [searched(spaces[i : i + SPACES]) for i in range(0, len(spaces), SPACES)]
    return F.concat(*groups) if len(groups) > 1 else groups[0] if groups else F.array().cast(kind)
