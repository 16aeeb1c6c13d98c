"""Toxicity by Levenshtein automata over a learned lexicon trie.

Learning counts, over all labelled learning rows, in how many toxic and other texts each word
stands. Terms are words that toxic texts have far oftener than chance allows, in at least
`MIN_CONTEXTS` different neighbourhoods (copies of one text do not make a term). The terms form a
trie; intersected with Levenshtein automata it becomes one deterministic automaton, built state by
state as words need it, that accepts every word within a term's number of edits. Words that stand
in other texts and are merely close to a term are exceptions. All words that meet these conditions
are terms or exceptions, however many: conditions are joins and counts in Spark. Terms are the model
that every task holds; exceptions stay a table, which the near matches of the scored texts are joined
with.

Each match is weighed by its term's log odds, its edits and its context: a window of `WINDOW` words
on both sides tells a quotation (quotation marks around, words of reporting or naming) from abuse.
A logistic regression over the text's summed abuse and quotation, fitted on about `FIT_ROWS`
labelled rows, gives the score.

Defined cases: null and blank texts have no match and get the score of a text without one; without
labels, or if they are all alike, no term is learned and the score is the share of toxic labels (0
without any); null ids and repeated rows each keep a row and are scored alike; other columns are
ignored.
"""

from __future__ import annotations

import itertools
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import hash_sample, logistic, written

MIN_TEXTS = 3        # toxic texts that hold a term, at least
MIN_CONTEXTS = 3     # different neighbourhoods of a term in them, at least
MIN_LOG_ODDS = 3.0
EDIT_SHARE = (1.0, 0.8, 0.6)  # weight of a match with 0, 1 and 2 edits, before the labels correct it
WINDOW = 6           # words before and after a match that are its context
FIT_ROWS = 20_000    # labelled rows, chosen by hash, on which the regression is fitted
CACHE = 400_000      # words whose match a task remembers; bounds memory, not the result
FLUSH = 400_000      # words a task counts before it hands its sums on

# Marks and words of quotation, naming and reporting.
OPENING, CLOSING = "\"“„«‹‘'”", "\"”“»›’'"
REPORTING = set(
    "said says saying called calls calling word words term terms quote quoted quotes wrote written reported phrase means "
    "sagte sagt wort wörter begriff nannte genannt zitat zitiert heißt bedeutet "
    "dit disait mot mots terme appelé appelle citation cite écrit signifie "
    "dijo dice palabra palabras término llamó llama cita citado escribió significa".split())
EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "“”„«»‹›‘’…–—¡¿·"


def edits(term: str) -> int:
    """Edits in which a word may differ from a term."""
    return 0 if len(term) < 4 else 1 if len(term) < 8 else 2


def tokens(text: str) -> list[str]:
    return text.lower().split()


def word(token: str) -> str:
    return token.strip(EDGES)


class Lexicon:
    """A trie of terms intersected with the Levenshtein automata of all its terms.

    A state is a set of (trie node, edits so far). Transitions are computed when first needed.
    """

    def __init__(self, terms, exceptions: set[str] = frozenset()):
        self.terms, self.exceptions = list(terms), exceptions
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[int]] = [[]]   # terms that end at a node
        self.room = [0]                     # most edits that some term below a node allows
        for number, term in enumerate(self.terms):
            node = 0
            for letter in term:
                self.room[node] = max(self.room[node], edits(term))
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                    self.room.append(0)
                node = self.children[node][letter]
            self.room[node] = max(self.room[node], edits(term))
            self.ends[node].append(number)
        self.number: dict[frozenset, int] = {}
        self.states: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.accepts: list[tuple[int, int] | None] = []
        self.dead = self._state({})
        self.start = self._state(self._skipped({0: 0}))
        self.known: dict[str, int] = {}

    def _skipped(self, reached: dict[int, int]) -> dict[int, int]:
        """Adds the nodes reached by leaving out letters of a term."""
        queue = list(reached.items())
        for node, cost in queue:
            if reached[node] == cost:
                for child in self.children[node].values():
                    if cost + 1 <= self.room[child] and cost + 1 < reached.get(child, 9):
                        reached[child] = cost + 1
                        queue.append((child, cost + 1))
        return reached

    def _state(self, reached: dict[int, int]) -> int:
        state = frozenset(reached.items())
        if state not in self.number:
            self.number[state] = len(self.states)
            self.states.append(state)
            self.moves.append({})
            best = min(((cost, t) for node, cost in state for t in self.ends[node] if cost <= edits(self.terms[t])), default=None)
            self.accepts.append(best and (best[1], best[0]))
        return self.number[state]

    def _step(self, state: int, letter: str) -> int:
        reached: dict[int, int] = {}

        def reach(node: int, cost: int) -> None:
            if cost <= self.room[node] and cost < reached.get(node, 9):
                reached[node] = cost

        for node, cost in self.states[state]:
            reach(node, cost + 1)  # a letter too many
            for own, child in self.children[node].items():
                reach(child, cost + (own != letter))
        return self._state(self._skipped(reached))

    def match(self, plain: str) -> tuple[int, int] | None:
        """(term, edits) of the closest term within its edits."""
        state = self.start
        for letter in plain:
            after = self.moves[state].get(letter)
            if after is None:
                after = self.moves[state][letter] = self._step(state, letter)
            if after == self.dead:
                return None
            state = after
        return self.accepts[state]

    def code(self, token: str) -> int:
        """4 * term + edits, or -1."""
        plain = word(token)
        found = self.match(plain) if plain else None
        if found is None or found[1] and plain in self.exceptions:
            return -1
        return 4 * found[0] + found[1]

    def codes(self, words: list[str]) -> np.ndarray:
        out = np.fromiter(map(self.known.get, words, itertools.repeat(-2)), np.int64, len(words))
        unmet = np.flatnonzero(out == -2)
        if len(unmet):
            if len(self.known) > CACHE:
                self.known.clear()
            for i in unmet.tolist():
                token = words[i]
                if token not in self.known:
                    self.known[token] = self.code(token)
                out[i] = self.known[token]
        return out


def quotation(words: list[str], at: int) -> float:
    """0 (abuse) to 1 (quotation), from the window around a match."""
    before, after = words[max(0, at - WINDOW) : at + 1], words[at : at + WINDOW + 1]
    marked = any(w[0] in OPENING for w in before) and any(w.rstrip(".,;:!?")[-1:] in CLOSING and w.rstrip(".,;:!?") for w in after)
    named = any(word(w) in REPORTING for w in before[:-1] + after[1:])
    return min(1.0, 0.7 * marked + 0.3 * named)


NEAR = "struct<word:string,edits:int,abuse:double,quoted:double,hits:long>"
FIELDS = ["exact", "one", "two", "quoted", "hits"]


def evidence(text: str, lexicon: Lexicon, weights: list[list[float]]) -> tuple:
    """A text's abuse, quotation and matches by exact terms, and the same for each word near a term."""
    words = tokens(text)
    codes = lexicon.codes(words)
    exact, quoted, hits = 0.0, 0.0, 0
    near: dict[str, list] = {}
    for at in np.flatnonzero(codes >= 0).tolist():
        term, distance = divmod(int(codes[at]), 4)
        share, weight = quotation(words, at), weights[term][distance]
        if distance:
            held = near.setdefault(word(words[at]), [distance, 0.0, 0.0, 0])
            held[1], held[2], held[3] = held[1] + weight * (1 - share), held[2] + weight * share, held[3] + 1
        else:
            exact, quoted, hits = exact + weight * (1 - share), quoted + weight * share, hits + 1
    return exact, quoted, hits, [{"word": w, "edits": d, "abuse": a, "quoted": q, "hits": n} for w, (d, a, q, n) in near.items()]


def features(found: pd.DataFrame) -> np.ndarray:
    exact, one, two, quoted = (np.log1p(found[f].to_numpy(float)) for f in FIELDS[:4])
    some = np.minimum(found["exact"].to_numpy(float), 1)
    return np.stack([np.ones(len(found)), some, exact, one, two, quoted], axis=1)


def fit(found: pd.DataFrame, label: np.ndarray) -> list[float]:
    """Coefficients: exact matches first, then all, drawn to what exact matches say of misspelled ones."""
    x = features(found)
    plain = logistic(x[:, :3], label, ridge=1e-4)
    per_match = plain[2] + plain[1] / math.log(2)
    return logistic(x, label, ridge=1e-4, prior=[*plain, per_match, per_match, 0.0]).tolist()


def _word_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    sums = {0: Counter(), 1: Counter()}

    def handed() -> pd.DataFrame:
        out = pd.DataFrame([(w, c * y, c * (1 - y)) for y in (0, 1) for w, c in sums[y].items()], columns=["word", "toxic", "other"])
        for counter in sums.values():
            counter.clear()
        return out

    for batch in batches:
        for text, label in zip(batch["text"], batch["label"]):
            sums[label].update(set(map(word, tokens(text))))
            if sum(map(len, sums.values())) > FLUSH:
                yield handed()
    yield handed()


def _contexts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Neighbourhoods of each word, per batch no more different ones than a term must have."""
    for batch in batches:
        seen: dict[str, set[str]] = {}
        for text in batch["text"]:
            words = [word(w) for w in tokens(text)]
            for i, w in enumerate(words):
                held = seen.setdefault(w, set())
                if len(held) < MIN_CONTEXTS:
                    held.add(" ".join(words[max(0, i - 1) : i] + words[i + 1 : i + 2]))
        yield pd.DataFrame([(w, a) for w, held in seen.items() if w for a in sorted(held)], columns=["word", "around"])


class Words:
    """A table of words."""

    def __init__(self, table: DataFrame):
        self.table = table.select("word").distinct()

    def __contains__(self, plain: str) -> bool:
        return not self.table.where(F.col("word") == plain).isEmpty()


def learn(labelled: DataFrame) -> dict:
    """The model from rows (doc_id, text, label 0 or 1): terms with weights, exceptions, coefficients."""
    rows = labelled.where("text IS NOT NULL AND label IS NOT NULL").select("doc_id", "text", F.col("label").cast("int"))
    sizes = dict(rows.groupBy("label").count().collect())
    toxic, other = sizes.get(1, 0), sizes.get(0, 0)
    none = Words(rows.sparkSession.createDataFrame([], "word string"))
    model = {"terms": {}, "exceptions": none, "beta": None, "share": toxic / (toxic + other) if toxic else 0.0}
    if not toxic or not other:
        return model
    counts = written(
        rows.mapInPandas(_word_counts, "word string, toxic long, other long")
        .groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")).where("word <> ''"), "word-counts")
    vocabulary = counts.where(F.col("toxic") + F.col("other") >= MIN_TEXTS).count()
    odds = (F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("other") + 0.5) / (other + 1)))
    # how unlikely it is that a word's texts are toxic by chance, against the words that can be terms
    surprise = (F.col("toxic") * math.log((toxic + other) / toxic) - F.col("other") * math.log((toxic + other) / other)) > math.log(max(vocabulary, 1)) + 1
    strong = counts.where(F.col("toxic") >= MIN_TEXTS).withColumn("odds", odds).where((F.col("odds") >= MIN_LOG_ODDS) & surprise)
    around = (
        rows.where("label = 1").mapInPandas(_contexts, "word string, around string").distinct()
        .groupBy("word").count().where(F.col("count") >= MIN_CONTEXTS))
    # neighbourhoods decide before any word is handed on: words of copied texts are no terms, however many
    found = dict(strong.join(around, "word", "left_semi").select("word", "odds").collect())
    kept = sorted(found, key=lambda w: (-found[w], w))
    if not kept:
        return model
    top = found[kept[0]]
    model["terms"] = {w: [found[w] / top * s for s in EDIT_SHARE] for w in kept}

    def close(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicon = Lexicon(model["terms"])
        for batch in batches:
            rows = zip(batch["word"], batch["toxic"], batch["other"], map(lexicon.match, batch["word"]))
            yield pd.DataFrame([(w, t, o, lexicon.terms[m[0]], m[1]) for w, t, o, m in rows if m and m[1]],
                               columns=["word", "toxic", "other", "term", "edits"])

    model.pop("exceptions")  # the model goes to the tasks, tables do not
    near = written(counts.mapInPandas(close, "word string, toxic long, other long, term string, edits int"), "near-terms")
    # what a term's neighbourhood says of it: if its near words stand in other texts too, new ones will
    for r in near.groupBy("term", "edits").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")).collect():
        odds_near = math.log((r["toxic"] + 0.5) / (toxic + 1)) - math.log((r["other"] + 0.5) / (other + 1))
        share = min(max(odds_near / top, 0.0), 1.0) * EDIT_SHARE[r["edits"]]
        model["terms"][r["term"]][r["edits"]] = min(model["terms"][r["term"]][r["edits"]], share)
    model["exceptions"] = Words(near.where("other > 0"))
    # rows by hash of their text, copies of a text counting once
    sample = hash_sample(rows, F.col("text"), FIT_ROWS, toxic + other).withColumn("by", F.xxhash64("text"))
    fitted = score(sample.dropDuplicates(["by", "label"]), model, "text", "label").toPandas()
    if fitted["label"].nunique() == 2:
        model["beta"] = fit(fitted, fitted["label"].to_numpy(float))
    return model


def matches(docs: DataFrame, model: dict, text: Column) -> Column:
    """A column struct<exact, quoted, hits, near> for each row of `docs`, exceptions among the near words included."""
    shared = docs.sparkSession.sparkContext.broadcast(model["terms"])

    @F.pandas_udf(f"struct<exact:double,quoted:double,hits:long,near:array<{NEAR}>>")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        terms = shared.value
        lexicon, weights = Lexicon(terms), list(terms.values())
        for batch in batches:
            yield pd.DataFrame([evidence(t, lexicon, weights) for t in batch], columns=["exact", "quoted", "hits", "near"])

    return found(F.coalesce(text, F.lit("")))


def score(docs: DataFrame, model: dict, text: str, *keep: str) -> DataFrame:
    """Per row of `docs`: the columns `keep`, exact, one, two, quoted, hits and score.

    Near matches are joined with the exceptions by word, and what is left is added up per row.
    """
    found = written(
        docs.select(*keep, matches(docs, model, F.col(text)).alias("_m")).withColumn("_row", F.monotonically_increasing_id()), "toxic-matches")
    near = found.select("_row", F.explode("_m.near").alias("n")).select("_row", "n.*").join(model["exceptions"].table, "word", "left_anti")
    sums = near.groupBy("_row").agg(
        F.sum(F.when(F.col("edits") == 1, F.col("abuse"))).alias("_one"), F.sum(F.when(F.col("edits") == 2, F.col("abuse"))).alias("_two"),
        F.sum("quoted").alias("_quoted"), F.sum("hits").alias("_hits"))
    none = F.lit(0.0)
    rows = found.join(sums, "_row", "left").select(
        *keep, F.col("_m.exact").alias("exact"), F.coalesce("_one", none).alias("one"), F.coalesce("_two", none).alias("two"),
        (F.col("_m.quoted") + F.coalesce("_quoted", none)).alias("quoted"), (F.col("_m.hits") + F.coalesce("_hits", F.lit(0))).alias("hits"))
    if model["beta"] is None:
        return rows.withColumn("score", F.lit(float(model["share"])))
    terms = [F.lit(1.0), F.least("exact", F.lit(1.0)), *(F.log1p(f) for f in FIELDS[:4])]
    line = sum((F.lit(b) * t for b, t in zip(model["beta"][1:], terms[1:])), F.lit(model["beta"][0]))
    return rows.withColumn("score", 1 / (1 + F.exp(-line)))
