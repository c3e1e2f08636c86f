import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvane.lineage import shared_folder
from corvane.operators import classifiers as c, clusters as k, experiments as e, neighbours as n, scores as s, vectors as v


def blobs(spark, sizes=(30, 20), dim=3, seed=0, gap=8.0):
    draw = np.random.default_rng(seed)
    rows = []
    for label, size in enumerate(sizes):
        for x in draw.normal(label * gap, 1.0, (size, dim)):
            rows.append((len(rows), [float(y) for y in x], label))
    return spark.createDataFrame(rows, "id int, v array<float>, y int")


def brute(rows, queries, k, p):
    out = {}
    for q in queries:
        d = []
        for r in rows:
            gap = np.abs(np.array(q.v, dtype=float) - np.array(r.v, dtype=float))
            d.append((round(float(gap.max() if np.isinf(p) else (gap**p).sum() ** (1 / p)), 9), r.id))
        out[q.id] = [i for _, i in sorted(d)[:k]]
    return out


@pytest.mark.parametrize("p", [1, 2, 3, float("inf")])
def test_neighbours_equal_brute_force(spark, p):
    points, queries = blobs(spark, (60, 40), seed=1), blobs(spark, (15, 10), seed=2, gap=3.0)
    got = n.nearest_neighbours(queries, points, 5, "id", "id", "v", ["y"], p=p, pivots=4, block=8)
    found = {}
    for r in got.orderBy("query", "rank").collect():
        found.setdefault(r["query"], []).append(r.point)
    assert found == brute(points.collect(), queries.collect(), 5, p)


def test_pairs_of_blocks_are_dealt_by_number_and_sent_once(spark):
    points = spark.createDataFrame([(i, [float(i % 7), float(i % 5)]) for i in range(60)], "id long, v array<double>")
    near = n.nearest_neighbours(points, points, 3, "id", "id", "v", pivots=2, block=20)
    plan = near._jdf.queryExecution().executedPlan().toString()
    dealt = [x for x in plan.splitlines() if "Exchange" in x and "pair" in x]
    # bytes do not tell the work, so Spark must not put tasks together, nor send the rows a second time
    assert len(dealt) == 2 and all("REPARTITION_BY_NUM" in x for x in dealt)
    assert near.count() == 180


def test_neighbours_with_few_points_and_copies(spark):
    points = spark.createDataFrame([(i, [0.0, 0.0]) for i in range(9)] + [(9, [1.0, 0.0])], "id int, v array<float>")
    got = n.nearest_neighbours(points, points, 20, "id", "id", "v", pivots=3, block=2)
    assert got.count() == 100
    near = n.nearest_neighbours(points, points, 4, "id", "id", "v", pivots=3, block=2).filter("query = 9")
    assert sorted(r.point for r in near.collect()) == [0, 1, 2, 9]


def test_neighbours_stay_in_their_group(spark):
    points = blobs(spark, (20, 20)).withColumn("run", F.col("id") % 4)
    got = n.nearest_neighbours(points, points, 3, "id", "id", "v", by="run", pivots=4, block=3)
    assert got.filter(F.col("query") % 4 != F.col("point") % 4).count() == 0
    rows = points.collect()
    for run in range(4):
        mine = [r for r in rows if r.run == run]
        found = {}
        for r in got.filter(F.col("run") == run).orderBy("query", "rank").collect():
            found.setdefault(r["query"], []).append(r.point)
        assert found == brute(mine, mine, 3, 2)


@pytest.mark.parametrize("p", [1, 2])
def test_neighbours_in_other_folds(spark, p):
    df = blobs(spark, (40, 30), seed=3).withColumn("fold", F.col("id") % 5)
    rows, found = df.collect(), {}
    for r in n.nearest_neighbours(df, df, 6, "id", "id", "v", apart="fold", p=p, block=9).orderBy("query", "rank").collect():
        found.setdefault(r["query"], []).append(r.point)
    assert found == {r.id: brute([x for x in rows if x.fold != r.fold], [r], 6, p)[r.id] for r in rows}


def test_a_search_in_many_dimensions_copies_rows_to_few_tasks(spark):
    df = blobs(spark, (3000, 3000), dim=32, gap=0.1).repartition(4)
    folder = shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    near = n.nearest_neighbours(df, df, 3, "id", "id", "v")
    assert near.filter("rank = 1 and query = point").count() == 6000
    assert set(os.listdir(folder)) == before  # no table of copies


def test_equal_rows_decide_without_a_search(spark, monkeypatch):
    rows = [(1, [0.0], 0), (2, [0.0], 0), (3, [0.0], 1), (4, [5.0], 1), (5, [5.0], 0), (6, [5.5], 0), (7, [9.0], 1)]
    df = spark.createDataFrame(rows, "id int, v array<float>, y int")
    searched = []
    plain = c.nearest_neighbours
    monkeypatch.setattr(c, "nearest_neighbours", lambda q, *a: searched.extend(r.id for r in q.collect()) or plain(q, *a))
    got = {r.id: r.predicted for r in c.knn_classify(df, df, "id", "v", "y", k=4).collect()}
    # one hit each at 5.0: the nearer of the others, 5.5, decides
    assert got == {1: 0, 2: 0, 3: 0, 4: 0, 5: 0, 6: 0, 7: 1} and sorted(searched) == [4, 5]


def test_votes_by_distance_and_exact_hits(spark):
    near = spark.createDataFrame(
        [(1, 0.5, 0), (1, 1.0, 1), (1, 1.0, 1), (2, 0.0, 1), (2, 0.1, 0), (2, 0.1, 0)], "query int, dist double, y int"
    )
    assert {r["query"]: r.predicted for r in n.vote(near, "y").collect()} == {1: 0, 2: 1}
    assert {r["query"]: r.predicted for r in n.vote(near, "y", weights="uniform").collect()} == {1: 1, 2: 0}


def test_centres(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, [9.0, 9.0], 1)], "id int, v array<float>, y int")
    centres = n.centroids(df, "y", "v")
    assert {r.y: (r.centre, r.n) for r in centres.collect()} == {0: ([1.0, 0.0], 2), 1: ([9.0, 9.0], 1)}
    far = n.centre_distances(df, "v", centres, "y")
    assert {(r.id, r.centre_id): round(r.dist, 6) for r in far.collect()}[3, 1] == 0.0
    assert {r.id: r.centre_id for r in n.nearest_centre(far, "id").collect()} == {1: 0, 2: 0, 3: 1}
    assert {r.id for r in n.nearest_to_centres(far, "id", 1).collect()} == {1, 3}
    assert {r.y: r.radius for r in n.cluster_radius(df, "y", "v", centres, dims=2).collect()} == {0: 1.0, 1: 0.0}
    assert [(r.width, r.n) for r in n.vector_widths(df, "v").collect()] == [(2, 3)]


@pytest.mark.parametrize("block", [1, 2, 2000])
def test_centres_in_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(n, "CENTRE_BLOCK", block)
    df = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(12)], "id int, v array<double>")
    centres = spark.createDataFrame([(c, [at, 1.0]) for c, at in enumerate([1.0, 3.0, 7.0, 7.0, 20.0])], "y int, centre array<double>")
    far = n.centre_distances(df, "v", centres, "y")
    assert far.count() == 60 and far.agg(F.sum("dist")).first()[0] == sum(abs(i - at) for i in range(12) for at in (1, 3, 7, 7, 20))
    best = {r.id: (r.centre_id, r.dist) for r in n.assign_centre(df, "id", "v", centres, "y").collect()}
    assert best == {r.id: (r.centre_id, r.dist) for r in n.nearest_centre(far, "id").collect()}
    assert best[2] == (0, 1.0) and best[5] == (1, 2.0) and best[8] == (2, 1.0)


@pytest.mark.parametrize("algorithm", ["kmeans", "gmm", "ward", "bisecting", "birch", "spectral"])
def test_clusterings_find_the_blobs(spark, algorithm):
    df = blobs(spark)
    options = {"ward": {"micro": 10}, "birch": {"threshold": 2.0, "micro": 5}, "spectral": {"gamma": 0.05, "neighbours": 40}}
    found = k.cluster(df.select("id", "v"), "id", "v", algorithm, 2, **options.get(algorithm, {}))
    both = found.join(df, "id")
    assert both.count() == 50
    assert s.adjusted_rand(s.contingency(both, "label", "y")).first().ari == 1.0


def test_merging_keeps_every_cell(spark):
    class Cell:
        def __init__(self, cell, n, at):
            self.cell, self.n, self.sums, self.squares = cell, n, [n * x for x in at], n * sum(x * x for x in at)

    cells = [Cell(0, 5, [0, 0]), Cell(1, 1, [9, 9]), Cell(2, 2, [0, 1]), Cell(3, 3, [9, 8])]
    assert k.merge_cells(cells, 2) == {0: 0, 2: 0, 1: 1, 3: 1}
    placed = k.with_features(spark.createDataFrame([(0, [0.0, 0.0]), (0, [0.0, 2.0]), (1, [5.0, 5.0])], "cell long, v array<double>"), "v")
    assert {r.cell: r.radius for r in k.cell_radii(placed).collect()} == {0: 1.0, 1: 0.0}


def features(spark):
    df = k.with_features(blobs(spark), "v").withColumn("features", F.col("features"))
    return df.select("id", "features", F.col("y").cast("double").alias("label"))


def test_trees_are_not_sent_again_for_every_pass(spark):
    df = features(spark).withColumn("label", (F.col("id") % 2).cast("double"))
    for make in (lambda **o: c.forest(numTrees=3, **o), lambda **o: c.boosted(maxIter=2, maxDepth=3, **o)):
        assert make().getCacheNodeIds()
        kept, sent = (make(cacheNodeIds=x).fit(df).toDebugString.split("\n", 1)[1] for x in (True, False))
        assert kept == sent


def test_models_separate_the_blobs(spark):
    df = features(spark)
    models = {
        "forest": c.forest(numTrees=3),
        "logistic": c.logistic(maxIter=20),
        "boosted": c.boosted(maxIter=2, maxDepth=2),
        "svm": c.linear_svm(50),
        "dense": c.dense_network(3, [4], maxIter=50),
    }
    got = {(r.model, r.split): r.accuracy for r in c.compare_models(df, df, models).collect()}
    assert len(got) == 10 and min(got.values()) > 0.95
    # naive Bayes looks at proportions, which differ little here; it only has to run on non-negative input
    positive = df.withColumn("features", k.array_to_vector(F.transform(k.vector_to_array("features"), lambda x: F.abs(x))))
    assert c.compare_models(positive, positive, {"naive_bayes": c.naive_bayes()}).count() == 2


def test_search_scores_inverted_predictions(spark):
    df = spark.createDataFrame([(0.0, 1.0), (1.0, 0.0), (1.0, 0.0)], "label double, prediction double")
    assert c.FlipAccuracy().evaluate(df) == 1.0
    search = c.grid_search(features(spark), c.linear_svm(50, maxIter=5), {"regParam": [0.1, 0.01]}, folds=2)
    rows = c.grid_scores(search, ["regParam"])
    assert [r["regParam"] for r in rows] == [0.1, 0.01] and min(r["score"] for r in rows) > 0.9


def test_neighbour_classifier_and_grid(spark):
    df = blobs(spark)
    got = c.knn_classify(df, df, "id", "v", "y", k=3).join(df, "id")
    assert got.filter("predicted <> y").count() == 0
    folds = df.withColumn("fold", F.col("id") % 3)
    grid = c.knn_grid(folds, "id", "v", "y", "fold", ks=[1, 3], ps=[1, 2]).collect()
    assert len(grid) == 8 and min(r.score for r in grid) == 1.0


def means(df):
    return {(r.split, r.metric): r.value for r in df.collect()}


def test_cluster_experiments_on_clear_clusters(spark):
    df = blobs(spark)
    got = means(e.majority_experiment(df, "id", "v", "y", runs=2, votes=5, restarts=1))
    assert got["train", "accuracy"] == got["test", "accuracy"] == 1.0
    # raw cluster numbers may be the other way round, so the score is near 0, 1/2 or 1
    got = means(e.knn_on_clusters(df, "id", "v", "y", runs=2, neighbours=3, restarts=1))
    assert got["test", "accuracy"] in (0.0, 0.5, 1.0)


@pytest.mark.parametrize("model", ["svm", "dense", "knn"])
def test_supervised_labels_are_learned(spark, model):
    got = means(e.cluster_as_label(blobs(spark), "id", "v", "y", "supervised", model, folds=2))
    assert got["train", "accuracy"] == got["test", "accuracy"] == 1.0
    assert len(got) == 12


def test_inverted_labels_score_zero(spark):
    tune = {"c": [0.01], "folds": 2}
    got = means(e.cluster_as_label(blobs(spark), "id", "v", "y", "supervised", "svm", inverse=True, folds=2, tune=tune))
    assert got["test", "accuracy"] == 0.0


def test_word_and_document_vectors(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["c"])], "id int, tokens array<string>")
    model = v.fit_word_vectors(df, "tokens", size=4, window=2, epochs=1)
    words = v.vocabulary(model)
    entities = spark.createDataFrame([("a",), ("z",)], "word string")
    assert [r.word for r in v.known_entities(entities, words).collect()] == ["a"]
    assert len(v.entity_vectors(entities, words).first().v) == 4
    assert {len(r.vector) for r in v.document_vectors(model, df).collect()} == {4}


def test_training_tasks_follow_the_rows_up_to_the_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    assert v.training_parts(spark.range(9), rows=10) == 1 and v.training_parts(spark.range(9), least=4, rows=10) == 4
    assert v.training_parts(spark.range(30), rows=10) == 3 and v.training_parts(spark.range(10_000), rows=10) == cores


def test_embedding_against_communities(spark):
    df = blobs(spark, (4, 3)).select(F.concat(F.lit("w"), "id").alias("word"), "v", "y")
    parts = df.select(F.col("word").alias("id"), F.col("y").alias("community"))
    got = e.embedding_vs_community(df.drop("y"), parts).first()
    assert (got.n11, got.jaccard) == (9, 1.0)


def test_small_cells_are_halved_in_one_task_to_the_same_cells(spark, monkeypatch):
    rows = blobs(spark, (70, 50)).unionByName(spark.createDataFrame([(200 + i, [2.0, 2.0, 2.0], 0) for i in range(9)], "id int, v array<float>, y int"))
    wide = k.with_features(rows, "v").select("id", "features")
    cells = lambda whole: {r.id: r.cell for r in k.narrow_cells(wide, "id", 0.4, whole).collect()}
    by_rounds, mixed = cells(0), cells(20)
    written, plain = [], k.cut
    monkeypatch.setattr(k, "cut", lambda *a: written.append(a[1]) or plain(*a))
    assert cells(k.WHOLE_CELL) == mixed == by_rounds
    assert len(by_rounds) == 129 and len(set(by_rounds.values())) > 50
    assert written == ["cells", "radii", "cells"]


@pytest.mark.parametrize("p", [1, float("inf")])
def test_sums_of_gaps_are_measured_in_levels_of_16_bits(p, monkeypatch):
    draw = np.random.default_rng(5)
    rows, plain, measured = draw.normal(size=(300, 64)).astype(np.float32), n._levels, []
    monkeypatch.setattr(n, "_levels", lambda *a: measured.append(plain(*a)) or measured[-1])
    part = draw.integers(0, 3, 300)
    gaps = np.abs(rows[:, None].astype(float) - rows)
    far = gaps.max(axis=2) if np.isinf(p) else gaps.sum(axis=2)
    far[part[:, None] == part] = np.inf
    q, r, d, rank = (np.concatenate(x) for x in zip(*n._nearest(rows, rows, 20, p, part, part)))
    assert measured[0] is not None and len(q) == 6_000
    assert (r[np.lexsort((rank, q))].reshape(300, 20) == np.argsort(far, axis=1, kind="stable")[:, :20]).all()
    # no levels where one far row would make them coarse, nor where all rows are equal
    assert plain(rows, np.concatenate([rows, np.full((1, 64), 1e4, np.float32)]), 1) is None
    assert plain(rows[:1], rows[:1], p) is None and plain(rows[:0], rows, p) is None
