import numpy as np
import pytest

from corpusmill.operators import outliers

NAMES = ("a", "b")


def brute_lof(x, k):
    n = len(x)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    near = [sorted((d[i, j], *x[j], j) for j in range(n) if j != i)[:k] for i in range(n)]
    kd = [m[-1][0] for m in near]
    lrd = [1 / (np.mean([max(kd[m[-1]], m[0]) for m in near[i]]) + 1e-10) for i in range(n)]
    return [np.mean([lrd[m[-1]] for m in near[i]]) / lrd[i] for i in range(n)]


@pytest.mark.parametrize("block_rows", [2000, 7, 1])
def test_lof_is_exact_with_ties_and_copies(frame, block_rows):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 25, (90, 2)).astype(float)
    x[:15] = x[0]
    x[80] = (400, 3)
    df = frame([(i, *map(float, r)) for i, r in enumerate(x)], "i int, a double, b double").repartition(5)
    got = {r.i: r.lof for r in outliers.local_outlier_factor(df, "i", NAMES, 6, 0.1, block_rows).collect()}
    assert np.allclose([got[i] for i in range(90)], brute_lof(x, 6), rtol=1e-9)


def test_lof_marks_a_tenth(frame):
    rng = np.random.default_rng(1)
    df = frame([(i, float(a), float(b)) for i, (a, b) in enumerate(rng.normal(size=(200, 2)))], "i int, a double, b double")
    out = outliers.local_outlier_factor(df, "i", NAMES)
    assert out.where("is_outlier").count() == 20


def test_forest_is_stable_and_finds_the_stranger(frame):
    rng = np.random.default_rng(2)
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(rng.normal(size=(300, 2)))] + [(999, 60.0, -60.0), (1000, None, 1.0)]
    df = frame(rows, "i int, a double, b double")
    one = {r.i: r.iso_score for r in outliers.isolation_forest(df, "i", NAMES).collect()}
    two = {r.i: (r.iso_score, r.is_outlier) for r in outliers.isolation_forest(df.repartition(9), "i", NAMES).collect()}
    assert one == {k: v for k, (v, _) in two.items()} and min(one, key=one.get) == 999 and two[999][1]
    assert 25 <= sum(o for _, o in two.values()) <= 31 and 1000 not in one


@pytest.mark.parametrize("n", [0, 1])
def test_too_few_rows(frame, n):
    df = frame([(1, 1.0, 2.0)][:n], "i int, a double, b double")
    for out in (outliers.isolation_forest(df, "i", NAMES), outliers.local_outlier_factor(df, "i", NAMES)):
        assert out.count() == n and out.where("is_outlier").count() == 0


@pytest.mark.parametrize("q", [0.0, 0.1, 0.5, 0.9, 1.0])
def test_quantile_is_numpys(frame, q):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(size=500), np.zeros(300), [1e9, -1e9]])
    df = frame([(float(v),) for v in x], "v double")
    assert np.isclose(outliers.exact_quantile(df, "v", q, bins=16, small=10), np.quantile(x, q), rtol=1e-12)
    assert outliers.exact_quantile(df.limit(0), "v", q) is None


def test_boxes_cover_space_and_split_ties():
    rng = np.random.default_rng(8)
    x = np.column_stack([np.full(400, 3.0), rng.integers(0, 3, 400), rng.normal(size=400)])
    boxes = outliers.Boxes(x, 20, 3)
    leaf = boxes.place(x)
    assert np.bincount(leaf).max() <= 40 and len(boxes.lows) >= 20
    point, near = boxes.touching(x, np.zeros(400))
    assert all(leaf[i] in near[point == i] for i in range(400)) and len(boxes.touching(x[:1], np.array([np.inf]))[1]) == len(boxes.lows)
    radius = rng.uniform(0, 2, 400)
    point, near = boxes.touching(x, radius)
    gap = np.sqrt((np.maximum(0, np.maximum(boxes.lows[None] - x[:, None], x[:, None] - boxes.highs[None])) ** 2).sum(2))
    assert set(zip(point.tolist(), near.tolist())) == {tuple(map(int, p)) for p in np.argwhere(gap <= radius[:, None])}


def test_leaves_larger_than_a_block_and_a_small_tree(frame, monkeypatch):
    """A tree over few of the vectors, as for very large tables: leaves are cut further by their tasks."""
    monkeypatch.setattr(outliers, "TREE_SAMPLE", 40)
    monkeypatch.setattr(outliers, "STEP", 500)
    rng = np.random.default_rng(11)
    x = np.round(rng.normal(size=(400, 2)) * rng.choice([1, 9], (400, 1)), 2)
    df = frame([(i, *map(float, r)) for i, r in enumerate(x)], "i int, a double, b double").repartition(3)
    got = {r.i: r.lof for r in outliers.local_outlier_factor(df, "i", NAMES, 5, 0.1, 10).collect()}
    assert np.allclose([got[i] for i in range(400)], brute_lof(x, 5), rtol=1e-9)
