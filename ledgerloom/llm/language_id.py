"""Language identification by prediction by partial matching (PPM).

Each language has a context tree over bytes of lower-cased UTF-8, of orders 0 to 3, counted over all
learning rows: every task counts its own 4-byte strings and Spark adds the counts up. In a context,
a byte seen n times costs -log2(n / (total + distinct)) bits; one not seen costs the escape,
-log2(distinct / (total + distinct)), and is coded in the next shorter context, at last uniformly
(escape method C, without exclusion). Statistics are frozen, so a text's exact code length in a
language is a sum of look-ups.

Every context of every language is kept, so what a language has learned does not depend on the size
of the others. The trees are stored sparsely: per order, sorted contexts with the escapes, and sorted
strings with the costs, of just those languages that have them. The costs of the different 4-byte
strings of some texts are looked up once for all of them.

A text's language is the one with the shortest code; its score is that language's posterior
probability under equal priors. Texts that are null or hold no letter are `und` with score 0, as are
all texts if there is nothing to learn from. Equal code lengths go to the first language in order of
names. Learning skips rows with a null language or text. Null ids and repeated rows each keep a row;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import written

ORDER = 3
MAX_CONTEXTS = None        # contexts of orders 2 and 3 kept for each language, the most frequent; None: all
START = b"\0" * ORDER      # context of a text's first bytes
SLICE = 1 << 20            # positions handled at once, by four languages; fewer by more
UNDECIDED = "und"


def strings(data: bytes) -> np.ndarray:
    """The 4-byte strings of `data` as integers, the predicted byte lowest; not those that predict START."""
    a = np.frombuffer(data, dtype=np.uint8).astype(np.uint32)
    if len(a) <= ORDER:
        return a[:0]
    codes = a[:-3] << 24 | a[1:-2] << 16 | a[2:-1] << 8 | a[3:]
    return codes[a[3:] != 0]


def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of 4-byte strings per language over a task's rows."""
    sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def add(lang: str, texts: list[bytes]) -> None:
        codes, n = np.unique(strings(START + START.join(texts)), return_counts=True)
        if lang in sums:
            codes, back = np.unique(np.concatenate([sums[lang][0], codes]), return_inverse=True)
            n = np.bincount(back, weights=np.concatenate([sums[lang][1], n])).astype(np.int64)
        sums[lang] = codes, n

    for batch in batches:
        for lang, part in batch.groupby("lang"):
            held, size = [], 0
            for text in part["text"]:
                held.append(text.lower().encode())
                size += len(held[-1])
                if size > 8 * SLICE:
                    add(lang, held)
                    held, size = [], 0
            add(lang, held)
    for lang, (codes, n) in sums.items():
        yield pd.DataFrame({"lang": lang, "code": codes.astype(np.int64), "n": n})


class Sparse:
    """Values by key and language: sorted keys, and for each the languages that have one."""

    def __init__(self, key: np.ndarray, lang: np.ndarray, value: np.ndarray):
        order = np.argsort(key, kind="stable")
        self.keys, first = np.unique(key[order], return_index=True)
        self.ends = np.append(first, len(key))
        self.lang, self.value = lang[order].astype(np.int16), value[order].astype(np.float32)

    def __call__(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places in `keys`, languages and values of all that is known of them."""
        at = np.searchsorted(self.keys, keys)
        rows = np.flatnonzero(self.keys[np.minimum(at, len(self.keys) - 1)] == keys) if len(self.keys) else at[:0]
        begins = self.ends[at[rows]]
        sizes = self.ends[at[rows] + 1] - begins
        index = np.arange(sizes.sum()) + np.repeat(begins - (np.cumsum(sizes) - sizes), sizes)
        return np.repeat(rows, sizes), self.lang[index], self.value[index]


def build(langs: list[str], code: np.ndarray, lang: np.ndarray, n: np.ndarray) -> dict:
    """The model: per order, escapes by context and code lengths by string, from counts of 4-byte strings."""
    orders = []
    for order in range(ORDER + 1):
        part = (code & ((1 << 8 * (order + 1)) - 1)) * len(langs) + lang
        pair, back = np.unique(part, return_inverse=True)  # a string of this order and a language
        seen = np.bincount(back, weights=n, minlength=len(pair))
        strings_, lang_ = pair // len(langs), pair % len(langs)
        context, back = np.unique((strings_ >> 8) * len(langs) + lang_, return_inverse=True)
        total, distinct = np.bincount(back, weights=seen), np.bincount(back)
        if order >= 2 and MAX_CONTEXTS is not None:
            ranked = np.lexsort((context, -total, context % len(langs)))
            first = np.searchsorted((context % len(langs))[ranked], np.arange(len(langs)))
            kept = np.zeros(len(context), dtype=bool)
            kept[ranked[np.arange(len(ranked)) - first[(context % len(langs))[ranked]] < MAX_CONTEXTS]] = True
        else:
            kept = np.ones(len(context), dtype=bool)
        some = kept[back]
        escapes = -np.log2(distinct / (total + distinct))
        costs = -np.log2(seen / (total + distinct)[back])
        orders.append((Sparse((context // len(langs))[kept].astype(np.uint32), (context % len(langs))[kept], escapes[kept]),
                       Sparse(strings_[some].astype(np.uint32), lang_[some], costs[some])))
    return {"langs": langs, "orders": orders}


class Model:
    """Code lengths and predictions from the tables of `build`."""

    def __init__(self, arrays: dict):
        self.langs, self.orders = arrays["langs"], arrays["orders"]
        self.slice = max(1 << 12, 4 * SLICE // max(len(self.langs), 4))

    def costs(self, codes: np.ndarray) -> np.ndarray:
        """Bits of the last byte of each 4-byte string under each language."""
        out = np.full((len(codes), len(self.langs)), 8.0, dtype=np.float32)  # order -1: all bytes alike
        for order, (escapes, known) in enumerate(self.orders):
            own = codes & np.uint32((1 << 8 * (order + 1)) - 1)
            rows, lang, bits = escapes(own >> np.uint32(8))
            out[rows, lang] += bits
            rows, lang, bits = known(own)
            out[rows, lang] = bits
        return out

    def all_code_lengths(self, texts: list[str]) -> np.ndarray:
        """Bits of each whole text under each language."""
        bits = np.zeros((len(texts), len(self.langs)))
        held, owners, size = [], [], 0

        def add_up() -> None:
            codes, back = np.unique(np.concatenate(held), return_inverse=True)
            sizes = np.array([len(h) for h in held])
            sums = np.add.reduceat(self.costs(codes)[back], np.cumsum(sizes) - sizes, axis=0, dtype=np.float64)
            np.add.at(bits, owners, sums)
            held.clear(), owners.clear()

        for owner, text in enumerate(texts):
            a = np.frombuffer(START + text.lower().encode(), dtype=np.uint8)
            for at in range(0, len(a) - ORDER, self.slice):
                b = a[at : at + self.slice + ORDER].astype(np.uint32)
                held.append(b[:-3] << 24 | b[1:-2] << 16 | b[2:-1] << 8 | b[3:])
                owners.append(owner)
                size += len(held[-1])
                if size >= self.slice:
                    add_up()
                    size = 0
        if held:
            add_up()
        return bits

    def code_lengths(self, text: str) -> np.ndarray:
        """Bits of the whole text under each language."""
        return self.all_code_lengths([text])[0]

    def decided(self, bits: np.ndarray) -> tuple[str, float]:
        best = int(np.argmin(bits))
        return self.langs[best], float(1 / np.exp2(np.maximum(bits[best] - bits, -1000)).sum())

    def predict(self, text: str) -> tuple[str, float]:
        return self.decided(self.code_lengths(text))


def fit(rows: DataFrame, text: str, lang: str) -> dict | None:
    """The model's tables, from all `rows` with a language and a text; None if there are none."""
    known = rows.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    partial = known.mapInPandas(counted, "lang string, code long, n long")
    strings_ = written(partial.groupBy("lang", "code").agg(F.sum("n").alias("n")), "ppm-counts")
    langs = sorted(r[0] for r in strings_.select("lang").distinct().collect())
    if not langs:
        return None
    number = F.array_position(F.array(*map(F.lit, langs)), F.col("lang")) - 1
    counts = strings_.select("code", number.cast("int").alias("lang"), "n").toPandas()  # as many as scripts and languages have, not rows
    return build(langs, *(counts[c].to_numpy(np.int64) for c in ("code", "lang", "n")))


def predicted(docs: DataFrame, model: dict | None, text):
    """A column struct<lang:string, score:double> for each row of `docs`."""
    undecided = F.struct(F.lit(UNDECIDED).alias("lang"), F.lit(0.0).alias("score"))
    if model is None:
        return undecided
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("struct<lang:string,score:double>")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = Model(shared.value)
        for batch in batches:
            yield pd.DataFrame([own.decided(b) for b in own.all_code_lengths(batch.tolist())], columns=["lang", "score"])

    # Spark's regular expressions stop at the first letter
    return F.when(F.coalesce(text.rlike(r"\p{L}"), F.lit(False)), predict(F.coalesce(text, F.lit("")))).otherwise(undecided)
