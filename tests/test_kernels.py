"""Kernel features, spectral clustering by landmarks and Ward's tree against plain versions."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvane.operators import clusters, hierarchy, kernels, scores


def rings(spark, n=300, seed=4):
    random.seed(seed)
    rows = []
    for i in range(n):
        radius, angle = (1.0 if i % 2 else 3.0) + random.gauss(0, 0.1), random.uniform(0, 2 * math.pi)
        rows.append((i, [radius * math.cos(angle), radius * math.sin(angle)], float(i % 2)))
    return spark.createDataFrame(rows, "id long, v array<double>, label double")


def test_landmark_features_are_the_kernel(spark):
    df = rings(spark, 60)
    found = kernels.fit_kernel_map(df, "v", "rbf", 0.5, landmarks=100)
    rows = np.array([r.v for r in df.orderBy("id").collect()])
    mapped = np.array([r.f for r in found.transform(df, "v", "f").orderBy("id").collect()])
    assert np.allclose(mapped @ mapped.T, kernels.kernel_matrix(rows, rows, "rbf", 0.5), atol=1e-6)
    assert np.allclose(kernels.gram(found.transform(df, "v", "f"), "f"), mapped.T @ mapped)
    assert kernels.scale_gamma(df, "v") == pytest.approx(1 / (2 * rows.var()))


def test_curved_kernels_beat_the_line_on_rings(spark):
    df = rings(spark)
    right = {}
    for kernel, degree in (("linear", 3), ("rbf", 3), ("poly", 4)):
        options = {} if kernel == "linear" else {"degree": degree, "landmarks": 64}
        got = kernels.kernel_svm(df, df, "v", kernel, c=10.0, **options)
        right[kernel] = got.select(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]
    assert right["linear"] < 0.8 < 0.97 < min(right["rbf"], right["poly"])


def test_search_over_kernels(spark):
    found = kernels.kernel_grid(rings(spark, 80), "v", [10.0], degrees=(2,), folds=2, landmarks=20, iterations=8).collect()
    assert len(found) == 3 + 1 and {r.kernel for r in found} == set(kernels.KERNELS)
    best = max(found, key=lambda r: r.score)
    assert best.score > 0.95 and best.kernel in ("rbf", "poly")


def test_spectral_separates_rings(spark):
    df = rings(spark)
    found = clusters.cluster(df, "id", "v", "spectral_landmarks", 2, gamma=5.0, landmarks=200)
    both = found.join(df.select("id", F.col("label").alias("y")), "id")
    assert both.count() == 300
    assert scores.adjusted_rand(scores.contingency(both, "label", "y")).first().ari > 0.97


def plain_ward(points):
    """Merged sets with their costs, always the cheapest pair."""
    groups = [([i], np.array(p)) for i, p in enumerate(points)]
    out = {}
    while len(groups) > 1:
        cost = lambda a, b: ((a[1] - b[1]) ** 2).sum() * len(a[0]) * len(b[0]) / (len(a[0]) + len(b[0]))
        _, i, j = min((cost(groups[i], groups[j]), i, j) for i in range(len(groups)) for j in range(i))
        a, b = groups.pop(i), groups.pop(j)
        members = a[0] + b[0]
        out[frozenset(members)] = cost(a, b)
        groups.append((members, (a[1] * len(a[0]) + b[1] * len(b[0])) / len(members)))
    return out


def tree_sets(tree, rows):
    """The same from a tree: every merge joins what lies below it, cheapest first."""
    members = {r.id: [r.key] for r in rows.collect()}
    out = {}
    for r in sorted(tree.collect(), key=lambda r: (r.cost, r.n)):
        members[r.low] = members[r.low] + members.pop(r.high)
        out[frozenset(members[r.low])] = r.cost
        assert len(members[r.low]) == r.n
    return out


@pytest.mark.parametrize(("n", "finish", "block"), [(150, 2048, 2048), (150, 12, 40), (1, 2048, 2048)])
def test_ward_tree_is_the_plain_one(spark, monkeypatch, n, finish, block):
    monkeypatch.setattr(hierarchy, "BLOCK", block)
    random.seed(8)
    points = [[random.gauss(0, 1) for _ in range(3)] for _ in range(n)]
    df = spark.createDataFrame(list(enumerate(points)), "key long, v array<double>").repartition(3)
    tree, rows = hierarchy.ward_tree(df, "key", "v", finish)
    got, want = tree_sets(tree, rows), plain_ward(points)
    assert set(got) == set(want)
    assert all(abs(got[x] - want[x]) < 1e-9 for x in want)


def test_ward_labels_with_equal_rows(spark):
    rows = [(i, [float(i % 3 > 1) * 9, 0.0]) for i in range(30)]
    df = spark.createDataFrame(rows, "key long, v array<double>")
    found = {r.key: r.label for r in clusters.cluster(df, "key", "v", "ward_tree", 2, finish=4).collect()}
    assert len(found) == 30 and len({found[i] for i in range(30) if i % 3 > 1} | {2 + found[i] for i in range(30) if i % 3 < 2}) == 2


def test_ward_search_in_small_blocks_and_its_shape(spark, monkeypatch):
    monkeypatch.setattr(hierarchy, "ROW_CHUNK", 7)
    draw = np.random.default_rng(4)
    means, n = draw.normal(size=(40, 3)), draw.integers(1, 5, 40)
    df = spark.createDataFrame([(i * 3, int(n[i]), means[i].tolist()) for i in range(40)], "id long, n long, mean array<double>")
    got = {r.id: r.near for r in hierarchy.nearest(df.filter("id < 60"), df, (2, 3)).collect()}
    cost = hierarchy.costs(n.astype(float), means, n.astype(float), means)
    np.fill_diagonal(cost, np.inf)
    assert got == {i * 3: int(cost[i].argmin()) * 3 for i in range(20)}
    # what is sent grows with the rows, not with their square
    sent = lambda rows: sum(x * rows for x in hierarchy.grid(rows, rows, 64, 36))
    assert sent(60_000) == 12 * 60_000 and sent(600_000) <= 20 * 600_000


@pytest.mark.parametrize("few", [1, 40])
def test_ward_search_is_exact_far_from_the_origin_and_between_near_ties(spark, monkeypatch, few):
    monkeypatch.setattr(hierarchy, "FEW", few)
    draw = np.random.default_rng(7)
    # differences of single precision's last places, and of half of them in double precision far out
    for means in (draw.integers(0, 40, (150, 3)) + 1e8, 1 + draw.integers(0, 40, (150, 3)) * 1e-6):
        n = draw.integers(1, 5, 150)
        rows = [(i, int(n[i]), [float(x) for x in means[i]]) for i in range(150)] + [(150, 1, [float("nan")] * 3)]
        df = spark.createDataFrame(rows, "id long, n long, mean array<double>")
        got = {r.id: (r.near, r.cost) for r in hierarchy.nearest(df, df, (2, 2)).collect()}
        gaps = ((means[:, None] - means) ** 2).sum(axis=2) * (n[:, None] * n / (n[:, None] + n))
        np.fill_diagonal(gaps, np.inf)
        assert set(got) == set(range(150))
        for i in range(150):
            # the least cost, and the smaller name among equals
            assert got[i][1] == pytest.approx(gaps[i].min(), rel=1e-9)
            assert gaps[i, got[i][0]] == pytest.approx(gaps[i].min(), rel=1e-9)
            assert got[i][0] <= int(gaps[i].argmin()) or gaps[i, got[i][0]] < gaps[i].min() * (1 + 1e-12)


def test_ward_search_in_runs_of_one_size(monkeypatch):
    monkeypatch.setattr(hierarchy, "FEW", 3)
    monkeypatch.setattr(hierarchy, "ROW_CHUNK", 4)
    sizes = np.array([1] * 9 + [2, 3] + [4] * 3 + [7])
    assert hierarchy._runs(sizes) == [(0, 4, True), (4, 8, True), (8, 9, True), (9, 11, False), (11, 14, True), (14, 15, False)]
    assert hierarchy._runs(sizes[:0]) == []
