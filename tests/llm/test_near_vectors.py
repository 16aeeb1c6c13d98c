import math

import numpy as np
import pytest

from ledgerloom.llm import near_vectors as nv

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, similar=0.98):
    """All pairs of distinct vectors."""
    def known(r):
        return r[2] is not None and r[1] and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])

    good, seen = [], set()
    for r in rows:
        if known(r):
            unit = nv.units(np.array([r[1]], dtype=np.float32).astype(float))[0] + 0.0
            if (r[0], r[2], unit.tobytes()) not in seen:
                seen.add((r[0], r[2], unit.tobytes()))
                good.append((r[0], r[2], unit))
    n, root = [0] * len(good), list(range(len(good)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, label, x) in enumerate(good):
        for j in range(i):
            if good[j][1] == label and len(good[j][2]) == len(x) and math.fsum(x * good[j][2]) >= similar:
                n[i], n[j] = n[i] + 1, n[j] + 1
                root[find(i)] = find(j)
    groups = {}
    for i, (key, _, _) in enumerate(good):
        if key is not None:
            groups[find(i)] = min(key, groups.get(find(i), key))
    out = [(g[0], n[i], groups.get(find(i)), g[0] == groups.get(find(i))) for i, g in enumerate(good)]
    return sorted(out + [(k, 0, k, True) for k in {r[0] for r in rows if not known(r)}], key=str)


def run(spark, rows, **options):
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS class", "2 AS cell", "'x' AS digest", "3 AS dim", "4 AS n", "5 AS x")
    found = nv.near_duplicates(frame, "vec_id", "embedding", "label", **options)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted((tuple(r) for r in found.collect()), key=str)


def near(rng, x, cosine):
    """A vector at the given cosine to x, moved in a random direction."""
    x = x / np.linalg.norm(x)
    noise = rng.normal(size=len(x))
    noise -= noise @ x * x
    return cosine * x + math.sqrt(1 - cosine ** 2) * noise / np.linalg.norm(noise)


def corpus(seed, vectors=1500, dim=24):
    rng = np.random.default_rng(seed)
    out = [rng.normal(size=dim) for _ in range(vectors)]
    for i in range(vectors // 2):
        out.append(rng.uniform(0.5, 2) * near(rng, out[int(rng.integers(len(out)))], 1 - 0.04 * rng.random() ** 2))
    labels = rng.choice([0, 0, 0, 1, 2, None], len(out))
    return [(int(i), [float(v) for v in x], None if labels[i] is None else int(labels[i])) for i, x in zip(rng.permutation(len(out)), out)]


@pytest.mark.parametrize("recall, part", [(1, 2048), (1, 40), (nv.RECALL, 2048)])
def test_against_all_pairs(spark, recall, part):
    """With recall 1 every link; by default all but about one in ten thousand at the threshold."""
    rows = corpus(2)
    assert run(spark, rows, recall=recall, part=part) == plain(rows)


def test_recall_over_a_fine_grid(spark, monkeypatch):
    """Many cells, so that most pairs near the threshold lie in two: still above the promised share."""
    rows = corpus(4, 2500)
    monkeypatch.setattr(nv, "CELL", 4)
    want, got = plain(rows), run(spark, rows)
    links = sum(r[1] for r in want)
    assert links > 500
    assert 0.998 * links <= sum(r[1] for r in got) <= links
    assert run(spark, rows, recall=1) == want


def test_near_copies_of_one_vector(spark):
    """A third of all rows near each other, cut into parts: counts are those of all pairs."""
    rng = np.random.default_rng(7)
    hot = rng.normal(size=16)
    rows = [(i, [float(v) for v in (near(rng, hot, 0.993) if i % 3 else rng.normal(size=16))], 1) for i in range(600)]
    assert run(spark, rows, part=32) == plain(rows)


def test_odd_rows(spark):
    x = [0.6, -0.8, 0.0]
    rows = [(i, x, 1) for i in range(50)] + [
        (3, x, 1), (60, [1.2, -1.6, -0.0], 1), (61, x, 2), (62, x, None), (63, None, 1), (64, [], 1), (65, [0.0, 0.0, 0.0], 1),
        (66, [0.1, None, 0.2], 1), (67, [float("nan"), 0.0, 1.0], 1), (68, [float("inf"), 0.0, 1.0], 1), (69, [0.6, -0.8], 1), (70, [0.6, -0.8], 1),
        (71, [2.0], 1), (72, [3e38], 1), (73, [-1.0], 1), (74, [1e-40], 1), (None, x, 1), (None, [1.0, 1.0, 1.0], 3), (None, [1.0, 1.0, 1.01], 3),
        (7, [0.0, 0.0, 5.0], 1), (63, None, 1)]
    assert run(spark, rows) == plain(rows)


def test_ids_beyond_doubles(spark):
    big = 2**62 + 1
    rows = [(big, [1.0, 0.0], 1), (big + 1, [1.0, 0.0], 1), (None, [0.0, 1.0], 1), (5, None, 1)]
    assert run(spark, rows) == sorted([(None, 0, None, True), (big, 1, big, True), (big + 1, 1, big, False), (5, 0, 5, True)], key=str)


def test_none(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None, 1)]) == [(1, 0, 1, True)]


@pytest.mark.parametrize("recall", [0.9, 0.9999, 1])
def test_traversal(recall):
    """Cells are visited exactly if the sum of the two squared gaps is within reach, and a gap is never
    more than the true distance to any vector of the cell."""
    rng = np.random.default_rng(1)
    sample = nv.units(rng.normal(size=(900, 10)))
    grid = nv.Grid(sample, 8, 0.98, recall)
    home, row, cell = grid.visits(sample[:200])
    (own1, gap1), (own2, gap2) = grid.gaps(sample[:200])
    width = len(grid.books[1])
    want = {(i, a * width + b) for i in range(200) for a in range(len(grid.books[0])) for b in range(width)
            if gap1[i, a] ** 2 + gap2[i, b] ** 2 <= grid.reach and a * width + b != home[i]}
    assert set(zip(row.tolist(), cell.tolist())) == want and len(row) == len(want)
    homes = grid.visits(sample)[0]
    apart = ((sample[:200, None] - sample[None]) ** 2).sum(axis=2)
    bound = (gap1 ** 2)[:, homes // width] + (gap2 ** 2)[:, homes % width]
    assert (bound <= apart + 1e-9).all()
