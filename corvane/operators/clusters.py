"""Clusterings of vector tables; all return (key, label) with labels from 0."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import BisectingKMeans, GaussianMixture, KMeans, PowerIterationClustering
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window, functions as F, types as T

from corvane.lineage import cut
from corvane.operators.fits import fit_each
from corvane.operators.hierarchy import ward_labels
from corvane.operators.kernels import spectral_embedding
from corvane.operators.neighbours import nearest_neighbours

WHOLE_CELL = 4096  # rows of a cell that one task halves to its end


def with_features(df: DataFrame, vector: str, output: str = "features") -> DataFrame:
    return df.withColumn(output, array_to_vector(F.col(vector)))


def fit_kmeans(df: DataFrame, k: int, restarts: int = 1, seed: int = 1, iterations: int = 300, tol: float = 1e-4):
    """Best of several starts by training cost; ``df`` has a ``features`` column."""
    models = fit_each(
        df.sparkSession,
        lambda i: KMeans(k=k, initMode="k-means||", maxIter=iterations, tol=tol, seed=seed + i).fit(df),
        range(restarts),
    )
    return min(models, key=lambda m: m.summary.trainingCost)


def _labels(model, df: DataFrame, key: str) -> DataFrame:
    return model.transform(df).select(key, F.col("prediction").alias("label"))


def kmeans(df: DataFrame, key: str, vector: str, k: int = 2, restarts: int = 3, seed: int = 1) -> DataFrame:
    points = with_features(df, vector).select(key, "features").persist()
    try:
        model = fit_kmeans(points, k, restarts, seed)
    finally:
        points.unpersist()
    return _labels(model, points, key)


def model_centres(spark, model) -> DataFrame:
    """(label, centre) of a fitted k-means."""
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return spark.createDataFrame(rows, "label int, centre array<double>")


def gaussian_mixture(df: DataFrame, key: str, vector: str, k: int = 2, seed: int = 1) -> DataFrame:
    points = with_features(df, vector).select(key, "features")
    return _labels(GaussianMixture(k=k, seed=seed).fit(points), points, key)


def bisecting(df: DataFrame, key: str, vector: str, k: int = 2, seed: int = 1) -> DataFrame:
    points = with_features(df, vector).select(key, "features")
    return _labels(BisectingKMeans(k=k, seed=seed).fit(points), points, key)


def cell_summaries(df: DataFrame, cell: str) -> DataFrame:
    """Count, sum and squared sum of every cell: what merging needs to know about its points."""
    stats = df.groupBy(cell).agg(
        F.count("*").alias("n"),
        Summarizer.sum(F.col("features")).alias("s"),
        Summarizer.normL2(F.col("features")).alias("q"),
    )
    squares = F.aggregate(vector_to_array("q"), F.lit(0.0), lambda acc, x: acc + x * x)
    return stats.select(F.col(cell).alias("cell"), "n", vector_to_array("s").alias("sums"), squares.alias("squares"))


def merge_cells(summaries: Sequence, k: int) -> dict[int, int]:
    """Ward's merges on the summaries of ``micro`` cells, until ``k`` groups are left."""
    groups = {r.cell: [r.cell] for r in summaries}
    n = {r.cell: float(r.n) for r in summaries}
    mean = {r.cell: np.array(r.sums) / r.n for r in summaries}
    while len(groups) > k:
        ids = sorted(groups)
        centres = np.stack([mean[i] for i in ids])
        sizes = np.array([n[i] for i in ids])
        gaps = ((centres[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2)
        cost = gaps * np.outer(sizes, sizes) / np.add.outer(sizes, sizes)
        np.fill_diagonal(cost, np.inf)
        i, j = np.unravel_index(cost.argmin(), cost.shape)
        a, b = ids[min(i, j)], ids[max(i, j)]
        mean[a] = (n[a] * mean[a] + n[b] * mean[b]) / (n[a] + n[b])
        n[a] += n[b]
        groups[a] += groups.pop(b)
    return {cell: label for label, a in enumerate(sorted(groups)) for cell in groups[a]}


def _relabel(df: DataFrame, key: str, cell: str, mapping: dict[int, int]) -> DataFrame:
    """Labels by position in a literal array of ``micro`` entries; empty cells never occur in rows."""
    table = F.array(*[F.lit(mapping.get(i, 0)) for i in range(max(mapping) + 1)])
    return df.select(key, F.get(table, F.col(cell)).alias("label"))


def ward(df: DataFrame, key: str, vector: str, k: int = 2, micro: int = 100, seed: int = 1) -> DataFrame:
    """Hierarchical clustering of micro-clusters: Spark summarises, only ``micro`` summaries are merged."""
    points = with_features(df, vector).select(key, "features")
    cells = fit_kmeans(points, micro, seed=seed, iterations=20).transform(points)
    summaries = cell_summaries(cells, "prediction").collect()
    return _relabel(cells, key, "prediction", merge_cells(summaries, k))


def birch(
    df: DataFrame, key: str, vector: str, k: int = 2, threshold: float = 0.5, micro: int = 200, seed: int = 1
) -> DataFrame:
    """Cells no wider than the threshold, however many that takes, then merged by their summaries.

    The means of the cells, weighted by their sizes, are grouped into ``micro`` clusters where there
    are more of them, and these are merged by Ward's criterion.
    """
    placed = narrow_cells(with_features(df, vector).select(key, "features"), key, threshold)
    means = cut(
        placed.groupBy("cell").agg(Summarizer.mean(F.col("features")).alias("features"), F.count("*").alias("weight")),
        "means",
    )
    few = [r.cell for r in means.select("cell").limit(micro + 1).collect()]
    if len(few) <= micro:
        groups = df.sparkSession.createDataFrame(list(zip(sorted(few), range(micro))), "cell bigint, prediction int")
    else:
        model = KMeans(k=micro, maxIter=20, seed=seed, weightCol="weight").fit(means)
        groups = cut(model.transform(means).select("cell", "prediction"), "groups")
    grouped = placed.join(groups, "cell").select(key, "features", "prediction")
    return _relabel(grouped, key, "prediction", merge_cells(cell_summaries(grouped, "prediction").collect(), k))


def cell_radii(placed: DataFrame) -> DataFrame:
    """(cell, n, radius, dim, at): rows; root mean square distance to the mean; the widest feature and its mean."""
    stats = placed.groupBy("cell").agg(
        F.count("*").alias("n"),
        vector_to_array(Summarizer.mean(F.col("features"))).alias("mean"),
        vector_to_array(Summarizer.variance(F.col("features"))).alias("spread"),
    )
    total = F.aggregate("spread", F.lit(0.0), lambda acc, x: acc + x)
    dim = F.array_position("spread", F.array_max("spread")).cast("int")
    radius = F.when(F.col("n") > 1, F.sqrt(total * (F.col("n") - 1) / F.col("n"))).otherwise(0.0)
    return stats.select("cell", "n", radius.alias("radius"), dim.alias("dim"), F.get("mean", dim - 1).alias("at"))


def halved(rows: np.ndarray, threshold: float) -> list[list[bool]]:
    """For every row the sides it takes where its cell is halved, by the rule of ``narrow_cells``."""
    paths: list[list[bool]] = [[] for _ in rows]
    open_cells = [np.arange(len(rows))] if len(rows) > 1 else []
    while open_cells:
        cell = open_cells.pop()
        x = rows[cell]
        mean = x.mean(axis=0)
        spread = ((x - mean) ** 2).sum(axis=0) / (len(x) - 1)
        if np.sqrt(spread.sum() * (len(x) - 1) / len(x)) <= threshold:
            continue
        dim = spread.argmax()
        right = x[:, dim] > mean[dim]
        for i, side in zip(cell.tolist(), right.tolist()):
            paths[i].append(side)
        if right.any() and not right.all():
            open_cells += [c for c in (cell[right], cell[~right]) if len(c) > 1]
    return paths


def narrow_cells(points: DataFrame, key: str, threshold: float, whole: int = WHOLE_CELL) -> DataFrame:
    """Points with a cell of radius at most ``threshold``.

    Every round halves the cells that are too wide at the mean of their widest feature. Cells of at most ``whole`` rows
    are halved to their end in one task each, so the rounds follow the depth down to such cells. Cells are named by a
    hash of their path. A cell whose points differ by less than rounding can show is left as it is.
    """
    done, small = [], []
    open_cells = cut(points.select(key, "features", F.lit(0).cast("bigint").alias("cell")), "cells")
    while True:
        radii = cut(cell_radii(open_cells), "radii")
        too_wide, few = F.col("radius") > threshold, F.col("n") <= whole
        of = lambda rows, which: rows.join(radii.filter(which).select("cell"), "cell", "left_semi").select(key, "features", "cell")
        done.append(of(open_cells, ~too_wide))
        small.append(of(open_cells, too_wide & few))
        wide = radii.filter(too_wide & ~few).select("cell", "dim", "at")
        if wide.isEmpty():
            break
        side = F.get(vector_to_array("features"), F.col("dim") - 1) > F.col("at")
        split = open_cells.join(wide, "cell").withColumn("right", side)
        halves = cut(split.select(key, "features", F.xxhash64("cell", "right").alias("cell"), F.col("cell").alias("was")), "cells")
        # rounding can leave all points of a cell on one side: such a cell is done
        parts = halves.groupBy("was").agg(F.min("cell").alias("a"), F.max("cell").alias("b"))
        stuck = cut(parts.filter("a = b").select("was"), "stuck")
        done.append(halves.join(stuck, "was").select(key, "features", "cell"))
        open_cells = halves.join(stuck, "was", "left_anti").select(key, "features", "cell")

    def finish(rows: pa.Table) -> pa.Table:
        values = pa.concat_arrays([c.flatten() for c in rows["x"].chunks]).to_numpy(zero_copy_only=False)
        paths = halved(values.reshape(rows.num_rows, -1), threshold)
        return rows.append_column("path", pa.array(paths, pa.list_(pa.bool_())))

    rows = reduce(DataFrame.unionByName, small).select(key, vector_to_array("features").alias("x"), "cell")
    out = T.StructType([*rows.schema.fields, T.StructField("path", T.ArrayType(T.BooleanType()))])
    name = F.aggregate("path", F.col("cell"), lambda cell, right: F.xxhash64(cell, right))
    ended = rows.groupBy("cell").applyInArrow(finish, out).select(key, array_to_vector("x").alias("features"), name.alias("cell"))
    return cut(reduce(DataFrame.unionByName, [*done, ended]), "cells")


def spectral(
    df: DataFrame,
    key: str,
    vector: str,
    k: int = 2,
    gamma: float = 1.0,
    neighbours: int = 10,
    iterations: int = 20,
) -> DataFrame:
    """Power iteration (Lin & Cohen, 2010) on Gaussian weights between near neighbours."""
    found = nearest_neighbours(df, df, neighbours + 1, key, key, vector).filter("query <> point")
    near = cut(found.select("query", "point", "dist"), "near")
    pairs = near.select(
        F.least("query", "point").alias("src"),
        F.greatest("query", "point").alias("dst"),
        F.exp(-F.lit(gamma) * F.col("dist") * F.col("dist")).alias("w"),
    )
    # the iterations send a point's value to every part that holds an edge of it, so edges lie by their end
    weighted = cut(pairs.repartition("src").groupBy("src", "dst").agg(F.max("w").alias("w")), "weighted")
    pic = PowerIterationClustering(
        k=k, maxIter=iterations, initMode="degree", srcCol="src", dstCol="dst", weightCol="w"
    )
    found = cut(pic.assignClusters(weighted).select(F.col("id").alias(key), F.col("cluster").alias("label")), "labels")
    # a point whose every neighbour was also cut off takes the label of its nearest labelled point
    alone = near.join(found.select(F.col(key).alias("query")), "query", "left_anti")
    nearest = Window.partitionBy("query").orderBy("dist", "point")
    adopted = (
        alone.join(found.withColumnRenamed(key, "point"), "point")
        .withColumn("r", F.row_number().over(nearest))
        .filter("r = 1")
        .select(F.col("query").alias(key), "label")
    )
    return found.unionByName(adopted)


def spectral_landmarks(
    df: DataFrame, key: str, vector: str, k: int = 2, gamma: float = 1.0, landmarks: int = 256, restarts: int = 3, seed: int = 1
) -> DataFrame:
    """Spectral clustering on the Gaussian affinity of all rows, by landmarks; k-means on the eigenvectors."""
    embedded = spectral_embedding(df.select(key, vector), vector, k, gamma, landmarks, seed)
    points = cut(with_features(embedded, "embedded").select(key, "features"), "embedded")
    return _labels(fit_kmeans(points, k, restarts, seed), points, key)


ALGORITHMS = {
    "kmeans": kmeans,
    "gmm": gaussian_mixture,
    "ward": ward,
    "bisecting": bisecting,
    "birch": birch,
    "spectral": spectral,
    "spectral_landmarks": spectral_landmarks,
    "ward_tree": ward_labels,
}


def cluster(df: DataFrame, key: str, vector: str, algorithm: str, k: int = 2, **options) -> DataFrame:
    return ALGORITHMS[algorithm](df, key, vector, k=k, **options)
