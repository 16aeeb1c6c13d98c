import functools
import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerloom.llm import token_alignment as ta
from ledgerloom.llm.common import vocabulary_path
from samples import documents, no_documents

A, B = vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model")
_a = Tokenizer.from_file(A)
_a.encode_special_tokens = True
_b = sentencepiece.SentencePieceProcessor(model_file=B)


@functools.cache
def a_bytes(i):
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(b): b for b in kept} | {chr(256 + n): b for n, b in enumerate(x for x in range(256) if x not in kept)}
    return bytes(table[c] for c in _a.id_to_token(i))


@functools.cache
def b_bytes(i):
    piece = _b.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if _b.is_byte(i) else piece.replace("▁", " ").encode()


def tokens(text):
    """(ids, ends) of A and B, or none."""
    a, b = _a.encode(" " + text, add_special_tokens=False).ids, _b.encode(text)
    if not text or b"".join(map(a_bytes, a)) != b" " + text.encode() or b"".join(map(b_bytes, b)) != b" " + text.encode():
        return None
    return (a, np.cumsum([len(a_bytes(i)) for i in a]).tolist()), (b, np.cumsum([len(b_bytes(i)) for i in b]).tolist())


def plain(rows):
    """The contract: groups by common ends, links by all overlaps of a group, counts over all rows."""
    parts, count = [], Counter()
    for doc_id, text in rows:
        found = tokens(text or "")
        if found is None:
            parts.append((doc_id, None, []))
            continue
        (a, a_ends), (b, b_ends) = found
        groups, links, i, j = [], [], 0, 0
        for end in sorted(set(a_ends) & set(b_ends)):
            i2, j2 = a_ends.index(end, i) + 1, b_ends.index(end, j) + 1
            groups.append((a[i:i2], b[j:j2]))
            for x in range(i, i2):
                for y in range(j, j2):
                    if max(a_ends[x - 1] if x else 0, b_ends[y - 1] if y else 0) < min(a_ends[x], b_ends[y]):
                        links.append((a[x], b[y]))
            i, j = i2, j2
        parts.append((doc_id, groups, links))
        count.update(links)
    most = Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    out = []
    for doc_id, groups, links in parts:
        if groups is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((doc_id, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
                    sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def check(docs):
    found = ta.align(docs, "doc_id", "text", A, B)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain(rows)


def test_documents(spark):
    check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(3))


def test_odd_texts(spark):
    odd = [None, "", " ", "  ", "a", "a ", " a", " a  b ", "\n", "a\n b\t c", "é ë x", "漢字 です é<|endoftext|> <s> </s> x", "🙂 🙂🙂",
           "▁", "a▁b ▁ c", "᠎ x", "a᠎ b", "x  y", "a\x00b", "don't can't I'll 12345 6789!?", "same text", "same text",
           "word " * 3000 + "end", "x" * 5000, "<0x41> <unk>", "ﬁ ½ Ａ", "﻿a", "á b"]
    check(documents(spark, odd).repartition(2))


def test_none(spark):
    check(no_documents(spark))
    check(documents(spark, [None, "", "▁"]))


def test_long_ids(spark):
    check(documents(spark, ["a b", "c"]).withColumn("doc_id", F.col("doc_id") + 2**62 + 1))


@pytest.mark.parametrize("seed", range(20))
def test_pointer_jumping(seed):
    """Last tokens of components against a union of all overlapping pairs."""
    rng = np.random.default_rng(seed)
    size = int(rng.integers(1, 60))
    cuts = [np.unique(np.concatenate([rng.integers(1, size + 1, int(rng.integers(0, 40))), [size]])) for _ in range(2)]
    ends = np.concatenate(cuts)
    starts = np.concatenate([np.concatenate([[0], c[:-1]]) for c in cuts])
    is_b = np.arange(len(ends)) >= len(cuts[0])
    last = ta.last_tokens(starts, ends, is_b)
    root = list(range(len(ends)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    pairs = set()
    for i in range(len(cuts[0])):
        for j in range(len(cuts[0]), len(ends)):
            if max(starts[i], starts[j]) < min(ends[i], ends[j]):
                root[find(i)] = find(j)
                pairs.add((i, j - len(cuts[0])))
    assert [(last[i] == last[j]) for i in range(len(ends)) for j in range(i)] == [(find(i) == find(j)) for i in range(len(ends)) for j in range(i)]
    for i in range(len(ends)):
        group = [k for k in range(len(ends)) if find(k) == find(i)]
        assert ends[last[i]] == max(ends[group])
    n = len(cuts[0])
    assert set(zip(*(x.tolist() for x in ta.overlaps(starts[:n], ends[:n], starts[n:], ends[n:])))) == pairs


def test_trimmed_memory(monkeypatch):
    """Forgetting rare words, or all, changes no result."""
    monkeypatch.setattr(ta, "CACHE", 30)
    texts = [" ".join(f"word{(i * k) % 97}" for k in range(1, 25)) for i in range(40)]
    models = [open(x, "rb").read() for x in (A, B)]
    plain_one, trimmed = ta.Aligner(*models), ta.Aligner(*models)
    want = [(f.tolist(), g, plain_one.pairs[n].tolist()) for f, g, n in plain_one.align(texts)]
    got = []
    for i in range(0, 40, 4):
        got += [(f.tolist(), g, trimmed.pairs[n].tolist()) for f, g, n in trimmed.align(texts[i : i + 4])]
        trimmed.trim()
        assert len(trimmed.texts) <= 30
        if i == 20:
            monkeypatch.setattr(ta, "PAIRS", 5)
    assert got == want
