"""Token counts and pieces against the libraries themselves."""

import struct

import numpy as np
import pytest
import sentencepiece

from ledgerloom.llm import sentence_pieces as sp, token_counts as tc
from ledgerloom.llm.common import file_bytes, vocabulary_path
from samples import TEXTS, documents, no_documents

BYTES, PIECES = vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model")
HARD = TEXTS + ["ab" * 3000 + " c " * 50, " " * 4000 + "a" * 3000, "é<|endoftext|>" * 300, "x\x85 y \x1c z", "漢字" * 900, "1234567890" * 200,
                "\t\t a", "<s> hi </s>", "a\x00b", " lead", "trail ", "x  y   z", "  ᠎ a"]


@pytest.mark.parametrize("chunk, overlap", [(65_536, 1_024), (500, 60), (300, 100)])
def test_counts(spark, chunk, overlap):
    docs = documents(spark, HARD)
    found = tc.count_tokens(docs, "doc_id", "text", BYTES, chunk, overlap).collect()
    library = tc.load(file_bytes(BYTES))
    texts = {t or "" for t in HARD} | {"without an id"}
    expected = {t: (len(t.encode()), len(library.encode(t, add_special_tokens=False).ids)) for t in texts}
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in found) == sorted((str(i), *expected[t or ""]) for i, t in rows)


def test_counts_empty(spark):
    assert tc.count_tokens(no_documents(spark), "doc_id", "text", BYTES).count() == 0


def test_pieces(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    docs = documents(spark, HARD)
    rows = sorted(((r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()), key=str)
    found = sorted(sp.encode(docs, "doc_id", "text", PIECES).collect(), key=lambda r: (str((r.doc_id, r.decoded))))
    assert len(found) == len(rows)
    by_id = {i: t for i, t in rows}
    for r in found:
        text = by_id[r.doc_id]
        ids = library.encode(text)
        assert list(r.ids) == ids and r.decoded == library.decode(ids)
        assert list(r.ends) == sorted(r.ends) and len(r.ends) == len(ids)
        if ids:
            assert r.ends[-1] == len(text.encode())


def test_spans_are_the_library_s(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    encoder = sp.Encoder(file_bytes(PIECES))
    for text in ("Hello world", " a  b ", "x  y   z", "ein schöner Tag für dich", "a\nb"):
        ids, ends, _ = next(encoder.encode_all([text]))
        assert ends.tolist() == [p.end for p in library.encode(text, return_type="proto").pieces]


def test_pieces_empty(spark):
    assert sp.digests(sp.encode(no_documents(spark), "doc_id", "text", PIECES)).count() == 0


def double_array(rules):
    """A compiled map for single-byte keys and one two-byte key, laid out by hand."""
    targets, offsets = b"", {}
    for key, value in rules.items():
        offsets[key] = len(targets)
        targets += value + b"\0"
    units = [0] * 2048
    root = 256
    units[0] = root << 10
    base = 512
    for first in sorted({k[0] for k in rules}):
        node = root ^ first
        has_leaf = bytes([first]) in rules
        units[node] = first | (node ^ base) << 10 | (256 if has_leaf else 0)
        if has_leaf:
            units[base] = 0x80000000 | offsets[bytes([first])]
        for key in rules:
            if len(key) == 2 and key[0] == first:
                second = base ^ key[1]
                units[second] = key[1] | (second ^ (base + 512)) << 10 | 256
                units[base + 512] = 0x80000000 | offsets[key]
        base += 1024
    return struct.pack("<I", 4 * len(units)) + struct.pack(f"<{len(units)}I", *units) + targets


def test_longest_rule_wins_and_bytes_are_aligned():
    rules = sp.CharMap(double_array({b"a": b"X", b"ab": b"YZ!"}))
    assert rules.longest(b"abc", 0) == (2, b"YZ!") and rules.longest(b"ac", 0) == (1, b"X") and rules.longest(b"c", 0) is None
    normalizer = sp.Normalizer.__new__(sp.Normalizer)
    normalizer.map, normalizer.starts = rules, rules.first_bytes()
    normalizer.prefix, normalizer.squeeze, normalizer.escape, normalizer.mark = True, True, True, sp.SPACE.encode()
    data, origin = normalizer("  éab  a ")
    assert data.decode() == "▁éYZ!▁X"
    assert origin.tolist() == [2, 2, 2, 2, 3, 4, 4, 4, 6, 6, 6, 8, 10]


def test_alignment_without_rules():
    data, origin = sp.Normalizer(file_bytes(PIECES))("a é")
    assert data.decode() == "▁a▁é" and origin.tolist() == [0, 0, 0, 0, 1, 1, 1, 2, 3, 4]
    assert isinstance(origin, np.ndarray)
