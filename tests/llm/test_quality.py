import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import quality
from samples import documents, no_documents, prose

COLUMNS = ("text", "lang", "source", "n_chars")


def scores(docs, model):
    return docs.select("doc_id", "text", quality.scored(docs, model, *map(F.col, COLUMNS)).alias("s")).select("doc_id", "text", "s.*").collect()


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    known = labels.select("doc_id", F.col("quality").alias("q"))
    learned = known.where("doc_id % 3 <> 0")
    model = quality.learn(docs, learned, "doc_id", *COLUMNS)
    assert sum(model["lent"]) > 0
    truth = {r.doc_id: r.q for r in known.where("doc_id % 3 = 0").collect()}
    held = [(truth[r.doc_id], r.score) for r in scores(docs, model) if r.doc_id in truth]
    assert len(held) > 100 and np.mean([(s >= 0.5) == bool(q) for q, s in held]) > 0.97
    assert all(0 <= s <= 1 for _, s in held)


def test_views_teach_each_other():
    """Few labels, but each view separates the pool: what one is sure of, the other learns."""
    rng = np.random.default_rng(0)
    y = np.array([0.0, 1.0] * 10)
    hidden = rng.integers(0, 2, 2000).astype(float)
    view = lambda t, noise: np.stack([t + rng.normal(0, noise, len(t)), rng.normal(0, 1, len(t))], axis=1)
    model = quality.co_train((view(y, 0.2), view(y, 0.2)), y, (view(hidden, 0.2), view(hidden, 0.2)))
    assert min(model["lent"]) > 500
    for mean, scale, beta in model["views"]:
        assert beta[1] > 3 * abs(beta[2])


def test_metadata_counts_if_it_says_something(spark):
    rows = [(i, prose(i, 30), "en", "good" if i % 2 else "bad", 100) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = docs.where("doc_id < 200").select("doc_id", (F.col("source") == "good").cast("int").alias("quality"))
    found = scores(docs, quality.learn(docs, labels, "doc_id", *COLUMNS))
    assert np.mean([(r.score >= 0.5) == bool(r.doc_id % 2) for r in found if r.doc_id >= 200]) > 0.95


@pytest.mark.parametrize("labelled, expected", [([], 0.5), ([(1, None)], 0.5), ([(4, 1), (5, 1)], 1.0), ([(4, 0)], 0.0)])
def test_edges(spark, labelled, expected):
    docs = documents(spark)
    labels = spark.createDataFrame(labelled, "doc_id long, quality int")
    found = scores(docs, quality.learn(docs, labels, "doc_id", *COLUMNS))
    assert len(found) == docs.count()
    for r in found:
        assert r.score == (expected if (r.text or "").strip() else 0.0)


def test_mixed_labels_on_odd_rows(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(i, i % 2) for i in range(15)] + [(4, 1)], "doc_id long, quality int")
    model = quality.learn(docs, labels, "doc_id", *COLUMNS)
    assert all(0 <= r.score <= 1 for r in scores(docs, model))
    assert scores(no_documents(spark), model) == []
    assert scores(no_documents(spark), quality.learn(no_documents(spark), labels, "doc_id", *COLUMNS)) == []


def plain_rounds(labelled, y, pool):
    """Co-training with every row in memory: whole sorts in place of histograms, lent labels kept per row."""
    apart = np.arange(len(y)) % 5 == 0
    own, own_y = [x[~apart] for x in labelled], y[~apart]
    scales = [(x.mean(axis=0), x.std(axis=0) + 1e-6) for x in own]
    lent = [np.full(len(pool[0]), np.nan) for _ in own]

    def z(v, x):
        return np.hstack([np.ones((len(x), 1)), ((x - scales[v][0]) / scales[v][1]).clip(-8, 8)])

    def fitted(betas, steps):
        out = []
        for v, beta in enumerate(betas):
            has = ~np.isnan(lent[v])
            weight = 0.5 * min(1.0, len(own_y) / max(has.sum(), 1))
            x, label = np.vstack([z(v, own[v]), z(v, pool[v][has])]), np.concatenate([own_y, lent[v][has]])
            w = np.concatenate([np.ones(len(own_y)), np.full(has.sum(), weight)])
            ridge = np.full(x.shape[1], 1e-3 * max(w.sum(), 1))
            ridge[0] = 1e-9
            for _ in range(steps):
                p = 1 / (1 + np.exp(-(x @ beta).clip(-30, 30)))
                step = np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x + np.diag(ridge + 1e-9), x.T @ (w * (label - p)) - ridge * beta)
                beta = beta + step * min(1, 5 / max(np.abs(step).max(), 1e-12))
            out.append(beta)
        return out

    betas = fitted([np.zeros(x.shape[1] + 1) for x in own], 5 * quality.STEPS)
    width = (30 - quality.LEAST) / quality.BINS
    for _ in range(quality.ROUNDS):
        logits = [(z(v, pool[v]) @ betas[v]).clip(-30, 30) for v in (0, 1)]
        news = []
        for v, logit in enumerate(logits):
            for label, sure, share in ((1.0, logit, y.mean()), (0.0, -logit, 1 - y.mean())):
                can = np.flatnonzero(np.isnan(lent[1 - v]) & (sure >= quality.LEAST))
                most = max(1, int(quality.LENT * share * len(logit)))
                bins = np.minimum(((sure[can] - quality.LEAST) / width).astype(int), quality.BINS - 1)
                fits = [b for b in sorted(set(bins)) if (bins >= b).sum() <= most]
                least = fits[0] if fits else bins.max(initial=0)
                news.append((1 - v, can[bins >= least], label))
        for to, rows, label in news:
            lent[to][rows] = label
        betas = fitted(betas, quality.STEPS)
    return betas, [int((~np.isnan(x)).sum()) for x in lent]


def test_rounds_over_the_whole_pool_against_plain_ones(spark):
    """The rounds of a table repeated in memory: the same labels lent and the same coefficients."""
    rows = [(i, prose(i, 20 + i % 40) + ("!!! $$$" if i % 3 == 0 else ""), "en" if i % 2 else None, f"s{i % 3}" if i % 5 else "x", i % 7 * 50) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(6)
    labels = docs.where("doc_id < 120").select("doc_id", (F.col("doc_id") % 3 != 0).cast("int").alias("quality"))
    model = quality.learn(docs, labels, "doc_id", *COLUMNS)
    seen = {r.doc_id: (r.look, r.meta) for r in quality._described(docs, *COLUMNS, "doc_id").collect()}
    known, others = sorted(i for i in seen if i < 120), sorted(i for i in seen if i >= 120)
    views = [tuple(np.array([seen[i][v] for i in ids]) for v in (0, 1)) for ids in (known, others)]
    betas, lent = plain_rounds(views[0], np.array([float(i % 3 != 0) for i in known]), views[1])
    assert model["lent"] == lent and min(lent) > 20
    for (_, _, beta), want in zip(model["views"], betas):
        assert beta == pytest.approx(want, rel=1e-4, abs=1e-5)


def test_threshold_lends_no_more_than_its_share():
    counts = np.zeros(quality.BINS, dtype=int)
    counts[[5, 100, 101, 1999]] = [40, 10, 10, 7]
    for most, want in ((7, 1999), (16, 1999), (17, 101), (27, 100), (66, 100), (67, 5), (3, 1999)):
        line = quality.threshold(counts, most)
        assert counts[quality.EDGES[:-1] >= line].sum() == counts[want:].sum()
    assert quality.threshold(np.zeros(quality.BINS), 5) == np.inf
