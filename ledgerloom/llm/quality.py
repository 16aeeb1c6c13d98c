"""Quality by co-training of two views.

One classifier sees what a text looks like (its letters, words and lines), the other sees only the
page's metadata. Both start from labelled rows. In each round each view scores all unlabelled rows,
and the rows of which it is most confident are added, with its label, to what the *other* view
learns from. At the end each view is calibrated on labelled rows kept apart, and a regression on the
calibrated views gives the score, the probability of good quality.

Labelled rows are a sample by hash of about `FIT_ROWS`. The pool is every unlabelled row with a text:
its features are written once and stay in Spark. How confident a row must be for its label to be lent
follows from a histogram over all of them, and a view learns by Newton steps whose sums Spark adds up
over all rows lent to it; only sums of fixed size reach the driver. Lent rows together weigh at most
half of the labelled ones. Which labels a row has been lent follows from the models of the rounds
so far, so no state is kept per row.

Defined cases: a null or blank text scores 0. Without any label every other text scores 0.5; if all
labels are alike, their value. Null metadata is a value of its own. Null ids and repeated rows are
scored like any other; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import hash_sample, logistic, with_small, written

FIT_ROWS = 20_000
ROUNDS = 5
CONFIDENT = 0.95       # probability from which a view lends its label
LENT = 0.1             # share of the pool that a view may label in a round
APART = 0.2            # of the labelled rows, for calibration and combination
BUCKETS = 64           # of hashed metadata values
LENT_WEIGHT = 0.5      # of a lent row, and of all of them against the labelled rows, at most
STEPS = 6              # of Newton's method per round, from the last round's coefficients
BINS = 2_000           # of the histogram of confidence, by log odds
SUMS = 64              # tasks whose sums the driver adds up; those of more tasks are first added up by as many

_SYMBOLS = [*b"#$%&*@^~+=<>|_{}[]\\/"]


def text_features(text: str) -> list[float]:
    """What a text looks like, whatever its language and length."""
    data = text.encode()
    n = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    words = text.split()
    lines = [x for x in text.split("\n") if x.strip()]
    upper, lower, digits = n[65:91].sum(), n[97:123].sum(), n[48:58].sum()
    size, count = max(len(data), 1), max(len(words), 1)
    common = Counter(words).most_common(1)[0][1] if words else 0
    distinct = len(set(words))
    return [
        np.log1p(len(words)), len(text) / count, upper / max(upper + lower, 1), digits / size,
        n[_SYMBOLS].sum() / size, n[33] / count, n[124] / count, n[[44, 46, 59, 58, 63]].sum() / count,
        sum(map(eq, words, words[1:])) / count, common / count,
        # repetition against what a natural text of that length has
        np.log((distinct + 1) / (count ** 0.8 + 1)), 1 - len(set(lines)) / max(len(lines), 1),
        np.log1p(count / max(len(lines), 1)), n[128:].sum() / size]


def _meta_features(lang: pd.Series, source: pd.Series, length: pd.Series) -> np.ndarray:
    """Metadata: hashed language and source, and the stated length."""
    out = np.zeros((len(lang), BUCKETS + 3))
    for values, salt in ((lang, "lang="), (source, "source=")):
        keys = (salt + values.fillna("\0").astype(str)).to_numpy()
        places = pd.util.hash_array(keys.astype(object)) % BUCKETS
        out[np.arange(len(lang)), places] += 1
    known = length.fillna(0).to_numpy(float).clip(0)
    out[:, -3], out[:, -2], out[:, -1] = np.log1p(known), np.log1p(known) ** 2 / 10, length.isna()
    return out


def _described(rows: DataFrame, text: str, lang: str, source: str, length: str, *keep: str) -> DataFrame:
    """`keep` columns and both views' features; null where there is no text."""
    @F.pandas_udf("struct<look:array<double>,meta:array<double>>")
    def described(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, langs, sources, lengths in batches:
            yield pd.DataFrame({
                "look": [text_features(t or "") for t in texts],
                "meta": list(_meta_features(langs, sources, lengths))})

    return rows.select(*keep, described(
        F.col(text), F.col(lang).cast("string"), F.col(source).cast("string"), F.col(length).cast("double")).alias("v")).select(*keep, "v.*")


class View:
    """One view's classifier: standardised features and a logistic regression."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, beta: np.ndarray | None = None):
        self.mean, self.scale = mean, scale
        self.beta = np.zeros(len(mean) + 1) if beta is None else beta

    def with_constant(self, x: np.ndarray) -> np.ndarray:
        return np.hstack([np.ones((len(x), 1)), ((x - self.mean) / self.scale).clip(-8, 8)])

    def logit(self, x: np.ndarray) -> np.ndarray:
        return (self.with_constant(x) @ self.beta).clip(-30, 30)

    def sums(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """What a Newton step needs of some rows: gradient and curvature, one under the other."""
        z = self.with_constant(x)
        p = _chance((z @ self.beta).clip(-30, 30))
        return np.vstack([z.T @ (weight * (y - p)), (z * (weight * p * (1 - p))[:, None]).T @ z])

    def stepped(self, sums: np.ndarray, total: float, ridge: float = 1e-3) -> "View":
        """The view after a Newton step; `ridge` times the rows draws coefficients to zero."""
        penalty = np.full(len(self.beta), ridge * max(total, 1))
        penalty[0] = 1e-9
        step = np.linalg.solve(sums[1:] + np.diag(penalty + 1e-9), sums[0] - penalty * self.beta)
        return View(self.mean, self.scale, self.beta + step * min(1, 5 / max(np.abs(step).max(), 1e-12)))


def _chance(logit: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-logit))


LEAST = float(np.log(CONFIDENT / (1 - CONFIDENT)))
EDGES = np.linspace(LEAST, 30, BINS + 1)


def lent_labels(seen: tuple[np.ndarray, np.ndarray], rounds: list) -> list[np.ndarray]:
    """The labels lent to each view for some rows, NaN where there is none; the first one stays.

    A round is, per lending view, the view and the log odds from which it lends 1 and 0.
    """
    lent = [np.full(len(seen[0]), np.nan), np.full(len(seen[0]), np.nan)]
    for round_ in rounds:
        for v, (view, good, bad) in enumerate(round_):
            logit, to = view.logit(seen[v]), lent[1 - v]
            free = np.isnan(to)
            to[free & (logit >= good)] = 1.0
            to[free & (-logit >= bad)] = 0.0
    return lent


def confidence(seen: tuple[np.ndarray, np.ndarray], views: list[View], rounds: list) -> np.ndarray:
    """Rows per bin of confidence by lending view and label (1, 0), of those without a lent label, then all rows."""
    out = np.zeros((5, BINS), dtype=np.int64)
    for v, (view, to) in enumerate(zip(views, reversed(lent_labels(seen, rounds)))):
        logit = view.logit(seen[v])[np.isnan(to)]
        for label, sure in ((0, logit), (1, -logit)):
            out[2 * v + label] = np.histogram(sure[sure >= LEAST].clip(max=30), EDGES)[0]
    out[4, 0] = len(seen[0])
    return out


def threshold(counts: np.ndarray, most: int) -> float:
    """The log odds from which at most `most` rows lend their label, or the surest bin of rows alone."""
    above = np.cumsum(counts[::-1])[::-1]
    fits = np.flatnonzero((above <= most) & (above > 0))
    if len(fits):
        return float(EDGES[fits[0]])
    return float(EDGES[np.flatnonzero(counts)[-1]]) if counts.any() else np.inf


def co_train(labelled: tuple[np.ndarray, np.ndarray], y: np.ndarray, pool) -> dict:
    """Both views and their combination, as plain arrays. Every fifth labelled row is kept apart.

    `pool` adds up a function of both views' features, an array of fixed shape, over the unlabelled
    rows; or it is these features themselves.
    """
    over_pool = pool if callable(pool) else lambda function, shape: np.asarray(function(pool), dtype=float).reshape(shape)
    apart = np.arange(len(y)) % round(1 / APART) == 0
    if len(set(y[apart])) < 2 or len(set(y[~apart])) < 2:
        apart = np.zeros(len(y), dtype=bool)
    own, own_y = tuple(x[~apart] for x in labelled), y[~apart]
    # scales come from the labelled rows, so that they are the same in every round
    views = [View(x.mean(axis=0), x.std(axis=0) + 1e-6) for x in own]
    shapes = [(len(v.beta) + 1, len(v.beta)) for v in views]
    rounds: list = []

    def learned(views: list[View], steps: int, lent: list[int]) -> list[View]:
        weights = [LENT_WEIGHT * min(1.0, len(own_y) / max(n, 1)) for n in lent]
        for _ in range(steps):
            sums = [v.sums(x, own_y, np.ones(len(own_y))) for v, x in zip(views, own)]
            if any(lent):
                def partial(seen, views=views):
                    out = []
                    for view, x, label, weight in zip(views, seen, lent_labels(seen, rounds), weights):
                        has = ~np.isnan(label)
                        out.append(view.sums(x[has], label[has], np.full(has.sum(), weight)).ravel())
                    return np.concatenate(out)

                more = over_pool(partial, (sum(a * b for a, b in shapes),))
                sums = [s + part.reshape(shape) for s, part, shape in zip(sums, np.split(more, [shapes[0][0] * shapes[0][1]]), shapes)]
            views = [v.stepped(s, len(own_y) + w * n) for v, s, w, n in zip(views, sums, weights, lent)]
        return views

    views = learned(views, 5 * STEPS, [0, 0])
    lent = [0, 0]
    for _ in range(ROUNDS):
        counts = over_pool(lambda seen: confidence(seen, views, rounds), (5, BINS))
        size = int(counts[4, 0])
        if not size:
            break
        shares = (y.mean(), 1 - y.mean())  # labels are lent in the proportion of the known ones
        lines = [threshold(counts[i], max(1, int(LENT * shares[i % 2] * size))) for i in range(4)]
        for i, line in enumerate(lines):
            lent[1 - i // 2] += int(counts[i][EDGES[:-1] >= line].sum())
        rounds.append([(views[v], lines[2 * v], lines[2 * v + 1]) for v in (0, 1)])
        views = learned(views, STEPS, lent)
    held = apart if apart.any() else ~apart
    calibrated, logits = [], []
    for v, view in enumerate(views):
        raw = view.logit(labelled[v][held])
        line = logistic(np.stack([np.ones(len(raw)), raw], axis=1), y[held], ridge=1e-3)
        line[1] = max(line[1], 0.0)
        calibrated.append(line)
        logits.append(line[0] + line[1] * raw)
    joint = logistic(np.stack([np.ones(held.sum()), *logits], axis=1), y[held], ridge=1e-3)
    return {"views": [(w.mean, w.scale, w.beta) for w in views], "lines": calibrated, "joint": joint, "lent": lent}


def pool_sums(pool: DataFrame, length: int):
    """A function that adds up an array-valued function of both views over the rows of `pool`, in its tasks,
    then over their sums."""
    tasks = pool.rdd.getNumPartitions()

    def over_pool(function, shape: tuple) -> np.ndarray:
        def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = None
            for batch in batches:
                for at in range(0, len(batch), 4096):
                    rows = batch.iloc[at : at + 4096]
                    seen = (np.array(rows["look"].tolist()).reshape(-1, length), _meta_features(rows["lang"], rows["source"], rows["length"]))
                    found = function(seen)
                    total = found if total is None else total + found
            if total is not None:
                yield pd.DataFrame({"sums": [np.ascontiguousarray(total, dtype=float).tobytes()]})

        def added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = None
            for batch in batches:
                for part in batch["sums"]:
                    total = np.frombuffer(part) + (0 if total is None else total)
            if total is not None:
                yield pd.DataFrame({"sums": [total.tobytes()]})

        parts = pool.mapInPandas(partial, "sums binary")
        if tasks > SUMS:
            parts = parts.repartition(SUMS).mapInPandas(added, "sums binary")
        parts = parts.collect()
        return sum((np.frombuffer(r["sums"]) for r in parts), np.zeros(int(np.prod(shape)))).reshape(shape)

    return over_pool


def learn(docs: DataFrame, labels: DataFrame, key: str, text: str, lang: str, source: str, length: str) -> dict:
    """The model from `docs` and a frame (key, label 0 or 1). Rows of one label count once each."""
    known = labels.select(F.col(labels.columns[0]).alias(key), F.col(labels.columns[1]).cast("double").alias("label")).where("label IS NOT NULL")
    n_known = known.count()
    if not n_known:
        return {"constant": 0.5}
    rows = with_small(docs.select(key, text, lang, source, length), known, key, "left").where(F.trim(text) != "")
    labelled = hash_sample(rows.where("label IS NOT NULL"), F.col(key), FIT_ROWS, n_known)
    frame = (
        _described(labelled, text, lang, source, length, key, "label").groupBy(key, "label").agg(F.min(F.struct("look", "meta")).alias("v"))
        .select(key, "label", "v.*").toPandas().sort_values([key, "label"], kind="stable"))
    y = frame["label"].to_numpy(float)
    if len(set(y)) < 2:
        return {"constant": float(y.mean()) if len(y) else 0.5}
    look, meta = (np.array(frame[c].tolist()) for c in ("look", "meta"))

    @F.pandas_udf("array<double>")
    def looks(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: text_features(t))

    pool = written(rows.where("label IS NULL").select(
        looks(text).alias("look"), F.col(lang).cast("string").alias("lang"), F.col(source).cast("string").alias("source"),
        F.col(length).cast("double").alias("length")), "quality-pool")
    return co_train((look, meta), y, pool_sums(pool, look.shape[1]))


def scored(docs: DataFrame, model: dict, text: Column, lang: Column, source: Column, length: Column) -> Column:
    """A column struct<score, look, meta>: the joint score and each view's calibrated one."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("struct<score:double,look:double,meta:double>")
    def score(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        own = shared.value
        views = [View(*parts) for parts in own.get("views", [])]
        for texts, langs, sources, lengths in batches:
            blank = np.array([not t or not t.strip() for t in texts])
            if views:
                seen = (np.array([text_features(t or "") for t in texts]), _meta_features(langs, sources, lengths))
                logits = [line[0] + line[1] * v.logit(x) for v, x, line in zip(views, seen, own["lines"])]
                joint = own["joint"]
                columns = [_chance((joint[0] + joint[1] * logits[0] + joint[2] * logits[1]).clip(-30, 30)), *map(_chance, logits)]
            else:
                columns = [np.full(len(texts), own["constant"])] * 3
            yield pd.DataFrame({n: np.where(blank, 0.0, c) for n, c in zip(("score", "look", "meta"), columns)})

    return score(text, lang.cast("string"), source.cast("string"), length.cast("double"))
