"""SentencePiece encoding and decoding that keeps byte offsets.

Normalisation follows the model's compiled character map: at every place the longest matching rule
is applied, else one character is copied, and each normalised byte remembers the original byte that
it came from. Pieces are laid over the normalised bytes and projected through that alignment, so
every piece has a span of original UTF-8 bytes; spans are in order and their union covers the text.

Ids are the library's. No piece of a supported vocabulary holds the space mark behind another
character, hence no merge crosses from a character to a following space mark, and a text may be
encoded word by word; words and their ids are remembered. Models for which this does not hold, or
that have user-defined pieces, are refused.

Input: any frame. Null text counts as empty (no ids, decoded text empty); null ids and repeated
rows each keep their own row; an empty frame gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import itertools
import re
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import file_bytes

SPACE = "▁"
CACHE = 300_000  # words whose ids a task remembers; it bounds memory, not the result
GROUP = 64       # texts encoded and handed on together

_WORD_STARTS = re.compile(f"(?<=[^ {SPACE}]) ")


def fields(message: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of each field of a serialised protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        number, kind = divmod(varint(), 8)
        if kind == 0:
            yield number, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield number, message[at : at + size]
            at += size


class CharMap:
    """A compiled character map: a double-array trie of source strings, then the replacements."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, dtype="<u4", count=size // 4, offset=4).tolist() if size else []
        self.targets = blob[4 + size :]

    def longest(self, source: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest rule that matches `source` at `at`."""
        units, found = self.units, None
        if not units:
            return None
        # Unit layout: bit 31 leaf, low 31 bits value; else bits 10-30 offset (bit 9: shifted by 8),
        # bit 8 has a leaf, low byte label.
        node = 0
        node ^= (units[0] >> 10) << ((units[0] & 512) >> 6)
        for end in range(at, len(source)):
            label = source[end]
            node ^= label
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != label:
                break
            node ^= (unit >> 10) << ((unit & 512) >> 6)
            if unit & 256:
                found = (end + 1 - at, units[node] & 0x7FFFFFFF)
        if found is None:
            return None
        start = found[1]
        return found[0], self.targets[start : self.targets.index(0, start)]

    def first_bytes(self) -> set[int]:
        """Bytes with which some rule begins."""
        if not self.units:
            return set()
        root = (self.units[0] >> 10) << ((self.units[0] & 512) >> 6)
        return {b for b in range(1, 256) if (n := root ^ b) < len(self.units) and self.units[n] & 0x800000FF == b}


class Normalizer:
    """Text to normalised UTF-8 and, for each normalised byte, the original byte it stands for."""

    def __init__(self, model: bytes):
        spec: dict[int, object] = {}
        for number, value in fields(model):
            if number == 3:
                spec = dict(fields(value))
        self.map = CharMap(spec.get(2, b""))
        self.prefix, self.squeeze, self.escape = (bool(spec.get(n, 1)) for n in (3, 4, 5))
        self.starts = self.map.first_bytes()
        self.mark = SPACE.encode() if self.escape else b" "

    def _mapped(self, source: bytes) -> tuple[np.ndarray, np.ndarray]:
        data = np.frombuffer(source, dtype=np.uint8)
        places = np.arange(len(data), dtype=np.int32)
        if not self.starts or not np.isin(data, list(self.starts)).any():
            return data, places
        out, origin, at = bytearray(), [], 0
        while at < len(source):
            rule = self.map.longest(source, at) if source[at] in self.starts else None
            if rule is None:
                length = 1
                while at + length < len(source) and source[at + length] & 0xC0 == 0x80:
                    length += 1
                out += source[at : at + length]
                origin.extend(range(at, at + length))
            else:
                length, target = rule
                out += target
                origin.extend([at] * len(target))
            at += length
        return np.frombuffer(bytes(out), dtype=np.uint8), np.array(origin, dtype=np.int32)

    def __call__(self, text: str) -> tuple[bytes, np.ndarray]:
        """The normalised bytes and their origins, with the text's byte length as last origin."""
        source = text.encode()
        data, origin = self._mapped(source)
        if self.squeeze:
            blank = data == 32
            keep = ~(blank & np.concatenate([[True], blank[:-1]])) if len(data) else blank
            data, origin = data[keep], origin[keep]
            if len(data) and data[-1] == 32:
                data, origin = data[:-1], origin[:-1]
        if not len(data):
            return b"", np.array([len(source)], dtype=np.int32)
        if self.prefix:
            data, origin = np.concatenate([[np.uint8(32)], data]), np.concatenate([origin[:1], origin])
        if self.escape:
            origin = np.repeat(origin, (data == 32) * (len(self.mark) - 1) + 1)
        return data.tobytes().replace(b" ", self.mark) if self.escape else data.tobytes(), np.append(origin, np.int32(len(source)))


class Encoder:
    """Ids and original byte spans of whole texts."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.normalizer = Normalizer(model)
        pieces = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        kinds = [dict(fields(v)).get(3, 1) for n, v in fields(model) if n == 1]
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces) or 4 in kinds:
            raise ValueError("this vocabulary cannot be encoded word by word")
        self.by_word = self.normalizer.prefix and self.normalizer.escape and not (
            self.normalizer.squeeze or self.normalizer.starts)
        byte = [self.library.is_byte(i) for i in range(len(pieces))]
        # an unknown piece stands for the characters it replaced; such texts are measured from the library
        self.sizes = np.array([1 if b else len(p.encode()) for p, b in zip(pieces, byte)], dtype=np.int64)
        self.unknown = self.library.unk_id()
        self.lone = self.library.encode("a ")[len(self.library.encode("a")) :]  # a space that ends a text
        self._forget()

    def _forget(self) -> None:
        self.row: dict[str, int] = {}  # word -> its place in the arrays
        self.flat = np.zeros(0, dtype=np.int32)
        self.starts = np.zeros(0, dtype=np.int64)
        self.counts = np.zeros(0, dtype=np.int64)
        self.is_odd = np.zeros(0, dtype=bool)
        self.odd: dict[int, str] = {}  # words that decode to another text, by place

    def _rows(self, words: list[str]) -> np.ndarray:
        """The words' places; words not met before are encoded first."""
        rows = np.fromiter(map(self.row.get, words, itertools.repeat(-1)), np.int64, len(words))
        unmet = np.flatnonzero(rows < 0)
        if not len(unmet):
            return rows
        new = list(dict.fromkeys(words[i] for i in unmet.tolist()))
        if len(self.row) + len(new) > CACHE and self.row:
            self._forget()
            return self._rows(words)
        encoded = [i if w else self.lone for w, i in zip(new, self.library.encode(new, num_threads=1))]
        first = len(self.row)
        self.row.update(zip(new, range(first, first + len(new))))
        odd = {first + i: d for i, (w, d) in enumerate(zip(new, self.library.decode(encoded, num_threads=1))) if w != d}
        self.odd.update(odd)
        self.is_odd = np.concatenate([self.is_odd, np.isin(np.arange(first, first + len(new)), list(odd))])
        counts = np.fromiter(map(len, encoded), np.int64, len(encoded))
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(counts) - counts])
        self.counts = np.concatenate([self.counts, counts])
        self.flat = np.concatenate([self.flat, np.fromiter(itertools.chain.from_iterable(encoded), np.int32, counts.sum())])
        rows[unmet] = [self.row[words[i]] for i in unmet.tolist()]
        return rows

    def _by_word(self, words: list[str], rows: np.ndarray) -> tuple[np.ndarray, str]:
        counts = self.counts[rows]
        ends = np.cumsum(counts)
        places = np.repeat(self.starts[rows] - ends + counts, counts) + np.arange(ends[-1])
        if self.is_odd[rows].any():
            words = [self.odd.get(r, w) for r, w in zip(rows.tolist(), words)]
        return self.flat[places], " ".join(words)

    def encode_all(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, str]]:
        """Ids, span ends and decoded text of each text; their new words are encoded together."""
        if self.by_word:
            split = [_WORD_STARTS.split(t) if "  " in t or SPACE in t or t[:1] == " " else t.split(" ") for t in texts]
            rows = self._rows(list(itertools.chain.from_iterable(split)))
            parts = np.split(rows, np.cumsum([len(w) for w in split])[:-1])
        for i, text in enumerate(texts):
            if self.by_word and text:
                ids, decoded = self._by_word(split[i], parts[i])
            else:
                found = self.library.encode(text)
                ids, decoded = np.array(found, dtype=np.int32), self.library.decode(found)
            yield ids, self.spans(text, ids).astype(np.int32), decoded

    def spans(self, text: str, ids: np.ndarray) -> np.ndarray:
        """Original byte offset at which each piece ends; it begins where the one before it ends."""
        normal, origin = self.normalizer(text)
        sizes = self.sizes[ids]
        if self.unknown >= 0 and (ids == self.unknown).any():
            plain = normal.decode().replace(SPACE, " ").removeprefix(" ")
            sizes = np.array([len(p.surface.encode()) for p in self.library.encode(plain, return_type="proto").pieces])
        return origin[np.cumsum(sizes)]


def encode(docs: DataFrame, key: str, text: str, model_path: str) -> DataFrame:
    """Per row of `docs`: the key (as `doc_id`), `ids`, `ends` (the original UTF-8 byte offset where
    each piece ends and the next begins) and `decoded`, the library's decoding of `ids`."""
    shared = docs.sparkSession.sparkContext.broadcast(file_bytes(model_path))

    @F.pandas_udf("struct<ids:array<int>,ends:array<int>,decoded:string>")
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(shared.value)
        for batch in batches:
            for at in range(0, len(batch), GROUP):  # small frames: the arrays are many times the text
                part = batch.iloc[at : at + GROUP].tolist()
                yield pd.DataFrame(list(encoder.encode_all(part)), columns=["ids", "ends", "decoded"])

    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.select("doc_id", encoded("text").alias("e")).select("doc_id", "e.ids", "e.ends", "e.decoded")


def digests(encoded: DataFrame) -> DataFrame:
    """Token count and SHA-256 digests of the ids (decimal, joined by commas) and the decoded text."""
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
