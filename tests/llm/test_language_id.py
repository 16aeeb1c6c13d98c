import math
import random
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as contract
from ledgerloom.llm import language_id as li
from samples import documents, no_documents, prose


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    rows = contract.queries()["op2_language_id"](spark, folder).join(docs, "doc_id").where("held_out AND lang IS NOT NULL").collect()
    assert len(rows) > 200 and sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.99
    assert all(0 <= r.score <= 1 for r in rows)


class Plain:
    """PPM by dictionaries: escape method C without exclusion, the longest kept context first."""

    def __init__(self, texts):
        self.counts = [defaultdict(Counter) for _ in range(li.ORDER + 1)]
        for text in texts:
            data = li.START + text.lower().encode()
            for i in range(li.ORDER, len(data)):
                for k in range(li.ORDER + 1):
                    self.counts[k][data[i - k : i]][data[i]] += 1

    def bits(self, context, byte, order):
        if order < 0:
            return 8.0
        seen = self.counts[order].get(context[len(context) - order :])
        if not seen:
            return self.bits(context, byte, order - 1)
        total = sum(seen.values()) + len(seen)
        if byte in seen:
            return -math.log2(seen[byte] / total)
        return -math.log2(len(seen) / total) + self.bits(context, byte, order - 1)

    def length(self, text):
        data = li.START + text.lower().encode()
        return sum(self.bits(data[i - li.ORDER : i], data[i], li.ORDER) for i in range(li.ORDER, len(data)))


def test_code_lengths_against_dictionaries(spark):
    texts = {"aa": [prose(1, letters="abcde"), "Äpfel über ABC"], "bb": [prose(2, letters="cdefg"), "zéro"]}
    rows = spark.createDataFrame([(t, lang) for lang, ts in texts.items() for t in ts] + [(None, "aa"), ("x", None), ("", "bb")], "t string, l string")
    model = li.Model(li.fit(rows, "t", "l"))
    assert model.langs == ["aa", "bb"]
    for probe in ("abcde", prose(3, 20, letters="abcdefg"), "ÜBER zéro 漢", "x"):
        expected = [Plain(texts[lang]).length(probe) for lang in model.langs]
        assert np.allclose(model.code_lengths(probe), expected, rtol=1e-5)


def test_pruned_contexts_fall_back(monkeypatch, spark):
    monkeypatch.setattr(li, "MAX_CONTEXTS", 3)
    rows = spark.createDataFrame([(prose(1, letters="abcde"), "aa"), (prose(2, letters="fghij"), "bb")], "t string, l string")
    model = li.Model(li.fit(rows, "t", "l"))
    assert model.predict(prose(4, letters="abcde"))[0] == "aa" and model.predict(prose(4, letters="fghij"))[0] == "bb"


def test_counts_survive_splitting():
    batch = pd.DataFrame({"text": [prose(i) for i in range(4)], "lang": ["a", "b", "a", "b"]})
    whole = pd.concat(li.counted(iter([batch]))).sort_values(["lang", "code"]).reset_index(drop=True)
    parts = pd.concat(li.counted(iter([batch[:1], batch[1:3], batch[3:]]))).sort_values(["lang", "code"]).reset_index(drop=True)
    pd.testing.assert_frame_equal(whole, parts)


def test_edges(spark):
    docs = documents(spark)
    model = li.fit(docs, "text", "lang")
    found = docs.select("doc_id", "text", li.predicted(docs, model, docs["text"]).alias("p")).select("doc_id", "text", "p.*").collect()
    assert len(found) == docs.count()
    for r in found:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang, r.score) == ("und", 0.0) if not letters else r.lang == "en" and r.score == 1.0
    assert li.fit(no_documents(spark), "text", "lang") is None
    assert docs.select(li.predicted(docs, None, docs["text"])["lang"].alias("l")).distinct().collect()[0].l == "und"


@pytest.mark.parametrize("seed", range(3))
def test_score_is_the_posterior(spark, seed):
    pick = random.Random(seed)
    rows = spark.createDataFrame([("aab" * 9, "x"), ("abb" * 9, "y")], "t string, l string")
    model = li.Model(li.fit(rows, "t", "l"))
    text = "".join(pick.choice("ab") for _ in range(4))
    bits = model.code_lengths(text)
    p = 2.0 ** -bits / (2.0 ** -bits).sum()
    assert model.predict(text) == (model.langs[int(np.argmin(bits))], pytest.approx(p.max()))


def test_rare_languages_keep_their_contexts(spark):
    """One large language with very many contexts beside two small related ones in another script."""
    pick = random.Random(0)
    large = ["".join(chr(pick.randrange(0x4E00, 0x9000)) for _ in range(400)) for _ in range(100)]
    related = {"x": ["абв бва вабг"], "y": ["авб баг вбав"]}  # the same letters equally often, in another order
    assert Counter(related["x"][0]) == Counter(related["y"][0])
    rows = spark.createDataFrame([(t, "zz") for t in large] + [(t, lang) for lang, ts in related.items() for t in ts], "t string, l string")
    model = li.Model(li.fit(rows, "t", "l"))
    for lang, texts in related.items():
        assert np.isclose(model.code_lengths(texts[0])[model.langs.index(lang)], Plain(texts).length(texts[0]), rtol=1e-5)
    assert np.isclose(model.code_lengths(large[0])[2], Plain(large).length(large[0]), rtol=1e-5)
    many = ["", large[3], "абв", large[4] * 3, "x"]
    assert np.allclose(model.all_code_lengths(many), [model.code_lengths(t) for t in many])


def test_long_texts_are_cut_without_loss(spark, monkeypatch):
    rows = spark.createDataFrame([(prose(1), "a"), (prose(2), "b")], "t string, l string")
    model = li.Model(li.fit(rows, "t", "l"))
    whole = model.code_lengths(prose(3) * 20)
    model.slice = 100
    assert np.allclose(model.code_lengths(prose(3) * 20), whole)
