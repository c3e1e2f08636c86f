"""Clusters used as labels: the end-to-end compositions.

Repeated hold-outs and folds live in one table with a ``run`` or ``fold`` column, so splitting,
neighbour search and scoring are single jobs over all repetitions; only model fits are repeated. Vectors are kept once,
with what each run does with them: between tasks only keys and labels travel once a run.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from corvane.functions.person import inverted, thresholded
from corvane.functions.vectors import distance
from corvane.lineage import cut
from corvane.operators import scores
from corvane.operators.classifiers import dense_network, grid_search, knn_classify, knn_classify_runs, linear_svm
from corvane.operators.clusters import cluster
from corvane.operators.features import assign_folds, oversample, stratified_holdout
from corvane.operators.fits import fit_each
from corvane.operators.neighbours import (
    centre_distances,
    centroids,
    nearest_of,
    nearest_to_centres,
)


def repeated_holdout(df: DataFrame, key: str, label: str, runs: int, fraction: float, seed: int) -> DataFrame:
    """Every row once per run, marked ``train`` or ``test`` by class."""
    repeated = df.withColumn("run", F.explode(F.sequence(F.lit(1), F.lit(runs))))
    return stratified_holdout(
        repeated.withColumn("__stratum", F.struct("run", label)), ["run", key], "__stratum", fraction, seed
    ).drop("__stratum")


def holdout_runs(df: DataFrame, key: str, label: str, runs: int, fraction: float, seed: int) -> DataFrame:
    """Every row once, with ``tests``, the runs of ``repeated_holdout`` in which it is a test row; only keys and labels are repeated."""
    marked = repeated_holdout(df.select(key, label), key, label, runs, fraction, seed)
    tests = marked.groupBy(key).agg(F.collect_set(F.when(F.col("split") == "test", F.col("run"))).alias("tests"))
    return df.join(tests, key)


def _cluster_runs(table: DataFrame, key: str, vector: str, algorithm: str, runs: int, k: int, seed: int, **o):
    """(run, key, cluster) of the training rows of every run."""

    def one(run: int) -> DataFrame:
        train = table.filter(~F.array_contains("tests", run)).select(key, vector)
        options = {**o, **({} if algorithm in ("spectral",) else {"seed": seed + run})}
        labels = cluster(train, key, vector, algorithm, k, **options)
        return labels.select(F.lit(run).alias("run"), key, F.col("label").alias("cluster"))

    return reduce(DataFrame.unionByName, fit_each(table.sparkSession, one, range(1, runs + 1)))


def clustered_runs(
    df: DataFrame, key: str, vector: str, truth: str, algorithm: str, runs: int, k: int, fraction: float, seed: int, **options
) -> DataFrame:
    """Every row once, with ``clusters``: its cluster in each run, null in the runs that hold it out."""
    table = cut(holdout_runs(df.select(key, vector, truth), key, truth, runs, fraction, seed), "runs")
    found = _cluster_runs(table, key, vector, algorithm, runs, k, seed, **options)
    named = found.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("run", "cluster"))).alias("by_run"))
    of_run = F.transform(F.sequence(F.lit(1), F.lit(runs)), lambda run: F.try_element_at("by_run", run))
    return cut(table.join(named, key, "left").select(key, vector, truth, of_run.alias("clusters")), "clusters")


def _each_run(table: DataFrame) -> DataFrame:
    """The rows of ``clustered_runs`` once per run, with ``run``, ``split`` and ``cluster``."""
    others = [c for c in table.columns if c != "clusters"]
    split = F.when(F.col("cluster").isNull(), "test").otherwise("train").alias("split")
    return table.select(*others, F.posexplode("clusters").alias("run", "cluster")).select(
        *others, (F.col("run") + 1).alias("run"), "cluster", split
    )


def majority_experiment(
    df: DataFrame,
    key: str,
    vector: str,
    truth: str,
    algorithm: str = "kmeans",
    runs: int = 30,
    k: int = 2,
    votes: int = 30,
    fraction: float = 0.2,
    seed: int = 1,
    **options,
) -> DataFrame:
    """Cluster, name every cluster by the ``votes`` points nearest to its centre, score both splits.

    Test rows take the class of the nearest centre. Returns (split, metric, value), means over runs.
    """
    every = _each_run(clustered_runs(df, key, vector, truth, algorithm, runs, k, fraction, seed, **options))
    centres = cut(centroids(every.filter("split = 'train'"), "cluster", vector, by=["run"]), "centres")
    placed = _with_centres_of_run(every, centres)
    near = placed.filter("split = 'train'").withColumn("__c", F.explode("__centres")).select(
        "run", key, truth, F.col("__c.id").alias("centre_id"), distance(F.col(vector), F.col("__c.at")).alias("dist")
    )
    voters = nearest_to_centres(near, key, votes, by=["run"])
    names = cut(scores.majority_label(voters, ["run", "centre_id"], truth), "names")
    train = every.filter("split = 'train'").select("run", truth, "split", F.col("cluster").alias("centre_id"))
    test = placed.filter("split = 'test'").select(
        "run", truth, "split", nearest_of(F.col(vector), F.col("__centres"))["centre_id"].alias("centre_id")
    )
    scored = train.unionByName(test).join(F.broadcast(names), ["run", "centre_id"])
    return _mean_by_split(scored, truth, "majority", ["run"])


def _with_centres_of_run(table: DataFrame, centres: DataFrame) -> DataFrame:
    """Every row with the centres of its run, a few, as one array."""
    mine = centres.groupBy("run").agg(
        F.collect_list(F.struct(F.col("cluster").alias("id"), F.col("centre").alias("at"))).alias("__centres")
    )
    return table.join(F.broadcast(cut(mine, "centres")), "run")  # a row a run


def _mean_by_split(scored: DataFrame, truth: str, predicted: str, repeat: Sequence[str]) -> DataFrame:
    by = [*repeat, "split"]
    wide = scores.classification_metrics(scored, truth, predicted, by)
    return scores.mean_scores(scores.long_scores(wide, by), ["split"])


def knn_on_clusters(
    df: DataFrame,
    key: str,
    vector: str,
    truth: str,
    algorithm: str = "kmeans",
    runs: int = 30,
    k: int = 2,
    neighbours: int = 20,
    fraction: float = 0.2,
    seed: int = 1,
    **options,
) -> DataFrame:
    """A neighbour classifier trained on cluster labels, scored against the truth, means over runs."""
    table = clustered_runs(df, key, vector, truth, algorithm, runs, k, fraction, seed, **options)
    predicted = knn_classify_runs(table, key, vector, "clusters", neighbours, math.ceil(1.5 * neighbours / (1 - fraction)) + 10)
    scored = predicted.join(_each_run(table.drop(vector)).select("run", key, "split", truth), ["run", key])
    return _mean_by_split(scored, truth, "predicted", ["run"])


def _predict(model: str, train: DataFrame, rows: DataFrame, key: str, vector: str, tune: dict | None, seed: int):
    """(split, key, copy, predicted) for ``rows`` by a model fitted on ``train`` and its cluster label."""
    keep = ["split", key, "copy"]
    if model == "knn":
        points = train.withColumn("__point", F.concat_ws("/", F.col(key), F.col("copy")))
        asked = rows.withColumn("__point", F.concat_ws("/", "split", F.col(key), F.col("copy")))
        votes = knn_classify(points, asked, "__point", vector, "cluster", (tune or {}).get("k", 10))
        return asked.join(votes, "__point").select(*keep, "predicted")
    fitted = train.withColumn("label", F.col("cluster").cast("double")).withColumn(
        "features", array_to_vector(F.col(vector))
    )
    n = fitted.count()
    width = len(fitted.first()[vector])
    if model == "svm":
        estimator = linear_svm(n, labelCol="label", featuresCol="features")
        grid = {"regParam": [1.0 / (c * n) for c in (tune or {}).get("c", [])]}
        fit = grid_search(fitted, estimator, grid, (tune or {}).get("folds", 3), seed=seed) if grid["regParam"] else (
            estimator.fit(fitted)
        )
    elif model == "dense":
        fit = dense_network(width, labelCol="label", featuresCol="features").fit(fitted)
    else:
        raise ValueError(f"unknown model {model}")
    asked = rows.withColumn("features", array_to_vector(F.col(vector)))
    return fit.transform(asked).select(*keep, thresholded(F.col("prediction")).alias("predicted"))


def cluster_as_label(
    df: DataFrame,
    key: str,
    vector: str,
    truth: str,
    algorithm: str = "kmeans",
    model: str = "svm",
    inverse: bool = False,
    folds: int = 10,
    tune: dict | None = None,
    seed: int = 1,
    **options,
) -> DataFrame:
    """Cluster once, train on the balanced cluster labels fold by fold, score against the truth.

    ``algorithm="supervised"`` trains on the truth itself; ``tune`` searches parameters inside
    the training part of each fold. Returns (split, metric, value), means over folds.
    """
    if algorithm == "supervised":
        labels = df.select(key, F.col(truth).alias("label"))
    else:
        labels = cluster(df, key, vector, algorithm, 2, **options)
    code = inverted(F.col("label")) if inverse else F.col("label")
    labelled = df.select(key, vector, truth).join(labels.select(key, code.alias("cluster")), key)
    table = cut(assign_folds(labelled, [key], folds, seed), "folds", partition_by="fold")

    def one(fold: int) -> DataFrame:
        train = cut(oversample(table.filter(F.col("fold") != fold), [key], "cluster", 0, 1, seed), "train")
        test = table.filter(F.col("fold") == fold).withColumn("copy", F.lit(0))
        rows = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
        predicted = _predict(model, train, rows, key, vector, tune, seed)
        return predicted.select(F.lit(fold).alias("fold"), "split", key, "predicted")

    scored = reduce(DataFrame.unionByName, fit_each(table.sparkSession, one, range(folds))).join(table.select(key, truth), key)
    return _mean_by_split(scored, truth, "predicted", ["fold"])


def embedding_vs_community(vectors: DataFrame, partition: DataFrame, restarts: int = 3, seed: int = 1) -> DataFrame:
    """Clusters of entity vectors (word, v) against graph communities (id, community).

    As many clusters as communities; entities are matched by name.
    """
    k = partition.select("community").distinct().count()
    clusters = cluster(vectors, "word", "v", "kmeans", max(k, 2), restarts=restarts, seed=seed)
    both = clusters.select(F.col("word").alias("id"), "label").join(partition, "id")
    return scores.pair_jaccard(scores.contingency(both, "label", "community"))
