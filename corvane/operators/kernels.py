"""Kernels as explicit features, by landmarks (Williams & Seeger, 2001).

A row becomes k(x, L) K(L, L)^(-1/2) for m landmark rows L: inner products of such features are the kernel, exactly so
between landmarks.  Linear methods on them are kernel methods that never form a matrix of all pairs: fitting is one
m x m eigenproblem on the driver (``landmarks`` bounds it), and every row is mapped where it lies.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from corvane.lineage import cut
from corvane.operators import classifiers

KERNELS = ("linear", "poly", "rbf", "sigmoid")


def kernel_matrix(a: np.ndarray, b: np.ndarray, kernel: str, gamma: float, degree: int = 3, coef0: float = 0.0) -> np.ndarray:
    if kernel == "rbf":
        gaps = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * a @ b.T
        return np.exp(-gamma * np.maximum(gaps, 0))
    products = a @ b.T
    if kernel == "linear":
        return products
    if kernel == "poly":
        return (gamma * products + coef0) ** degree
    if kernel == "sigmoid":
        return np.tanh(gamma * products + coef0)
    raise ValueError(f"unknown kernel {kernel}")


@dataclass
class KernelMap:
    """Landmarks and the matrix that turns kernel values with them into features."""

    landmarks: np.ndarray
    weights: np.ndarray
    kernel: str
    gamma: float
    degree: int
    coef0: float

    def features(self, rows: np.ndarray) -> np.ndarray:
        return kernel_matrix(rows, self.landmarks, self.kernel, self.gamma, self.degree, self.coef0) @ self.weights

    def transform(self, df: DataFrame, vector: str, output: str) -> DataFrame:
        """``df`` with the features of its array column ``vector`` as an array column."""
        return map_vectors(df, vector, output, self.features)


def map_vectors(df: DataFrame, vector: str, output: str, f: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """``df`` with a matrix function of its array column, applied to 2,048 rows at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 2048):
                part = batch.slice(first, 2048)
                found = f(matrix_of(part[vector]))
                edges = pa.array(np.arange(len(found) + 1) * found.shape[1], pa.int32())
                column = pa.ListArray.from_arrays(edges, pa.array(found.ravel(), pa.float64()))
                yield pa.RecordBatch.from_arrays([*part.columns, column], names=[*part.schema.names, output])

    plain = df.withColumn(vector, F.col(vector).cast("array<double>"))
    return plain.mapInArrow(run, plain.withColumn(output, F.lit(None).cast("array<double>")).schema)


def matrix_of(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def scale_gamma(df: DataFrame, vector: str) -> float:
    """1 / (width x variance of all components), the usual default."""
    x = df.select(F.size(vector).alias("d"), F.explode(vector).alias("x"))
    d, spread = x.agg(F.max("d"), F.var_pop(F.col("x").cast("double"))).first()
    return 1.0 / (d * spread) if d and spread else 1.0


def fit_kernel_map(
    df: DataFrame, vector: str, kernel: str = "rbf", gamma: float | None = None, degree: int = 3, coef0: float = 0.0,
    landmarks: int = 256, seed: int = 1,
) -> KernelMap:
    """A map on at most ``landmarks`` rows of ``df`` drawn at random, all of them where there are fewer.

    Directions that the kernel gives no or a negative weight (the sigmoid one is not positive) are left out.
    """
    gamma = scale_gamma(df, vector) if gamma is None else gamma
    drawn = df.select(F.col(vector).cast("array<double>").alias("v")).orderBy(F.xxhash64("v", F.lit(seed))).limit(landmarks)
    rows = np.array([r.v for r in drawn.collect()], dtype=np.float64)
    if not len(rows):
        raise ValueError("no rows to draw landmarks from")
    rows = np.unique(rows, axis=0)
    values, vectors = np.linalg.eigh(kernel_matrix(rows, rows, kernel, gamma, degree, coef0))
    kept = values > 1e-10 * max(np.abs(values).max(), 1e-300)
    if not kept.any():
        raise ValueError("the kernel has no positive direction on these rows")
    return KernelMap(rows, vectors[:, kept] / np.sqrt(values[kept]), kernel, gamma, degree, coef0)


def kernel_grid(
    train: DataFrame, vector: str, costs: Sequence[float], kernels: Sequence[str] = KERNELS, degrees: Sequence[int] = (3, 4, 5),
    folds: int = 10, fold: str | None = None, landmarks: int = 256, seed: int = 1, iterations: int = 100,
) -> DataFrame:
    """Cross-validated flip accuracy of support vector machines, as (kernel, degree, c, score).

    The degree only plays a part in the polynomial kernel; other kernels are searched once, with a null degree.
    ``train`` has an array column ``vector`` and ``label``.
    """
    spark, n = train.sparkSession, train.count()
    keep = ["label", *([fold] if fold else [])]
    rows = []
    for kernel in kernels:
        for degree in degrees if kernel == "poly" else [None]:
            if kernel == "linear":
                mapped = train.withColumn("features", array_to_vector(F.col(vector).cast("array<double>")))
            else:
                found = fit_kernel_map(train, vector, kernel, degree=degree or 3, landmarks=landmarks, seed=seed)
                mapped = found.transform(train.select(*keep, vector), vector, "mapped").withColumn("features", array_to_vector("mapped"))
            points = {1.0 / (c * n): c for c in costs}
            search = classifiers.grid_search(
                mapped.select(*keep, "features").coalesce(few_parts(n)), classifiers.linear_svm(n, maxIter=iterations), {"regParam": list(points)}, folds, fold=fold, seed=seed
            )
            rows += [(kernel, degree, float(points[r["regParam"]]), r["score"]) for r in classifiers.grid_scores(search, ["regParam"])]
    return spark.createDataFrame(rows, "kernel string, degree int, c double, score double")


def kernel_svm(train: DataFrame, rows: DataFrame, vector: str, kernel: str = "rbf", c: float = 1.0, **options) -> DataFrame:
    """``rows`` with the ``prediction`` of a support vector machine fitted on ``train(vector, label)``."""
    if kernel == "linear":  # needs no map
        mapped = [d.withColumn("features", array_to_vector(F.col(vector).cast("array<double>"))) for d in (train, rows)]
    else:
        found = fit_kernel_map(train, vector, kernel, **options)
        mapped = [found.transform(d, vector, "mapped").withColumn("features", array_to_vector("mapped")).drop("mapped") for d in (train, rows)]
    n = train.count()
    fitted = cut(mapped[0].select("features", "label").coalesce(few_parts(n)), "mapped")
    return classifiers.linear_svm(n, c).fit(fitted).transform(mapped[1]).drop("features", "rawPrediction")


def few_parts(n: int) -> int:
    """Every step of a fit is a job with a task a partition: small tables fit in few of them."""
    return 1 + n // 20_000


def vector_sums(df: DataFrame, column: str, by: str | None = None) -> DataFrame:
    """Sums of an array column, added up in every task first."""
    groups = df.groupBy(by) if by else df.groupBy()
    return groups.agg(Summarizer.sum(array_to_vector(F.col(column))).alias("s")).withColumn("s", vector_to_array("s"))


def gram(df: DataFrame, column: str) -> np.ndarray:
    """The sum of the outer products of an array column: m x m numbers from every task, and in all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                x = matrix_of(batch[column])
                total = x.T @ x if total is None else total + x.T @ x
        if total is not None:
            edges = pa.array(np.arange(len(total) + 1) * len(total), pa.int32())
            columns = [pa.array(np.arange(len(total)), pa.int32()), pa.ListArray.from_arrays(edges, pa.array(total.ravel()))]
            yield pa.RecordBatch.from_arrays(columns, names=["i", "row"])

    parts = df.select(column).mapInArrow(run, "i int, row array<double>")
    return np.array([r.s for r in vector_sums(parts, "row", "i").orderBy("i").collect()])


def spectral_embedding(
    df: DataFrame, vector: str, k: int, gamma: float = 1.0, landmarks: int = 256, seed: int = 1, output: str = "embedded"
) -> DataFrame:
    """Every row in the first ``k`` eigenvectors of the normalised Gaussian affinity of all rows (Fowlkes et al., 2004).

    The affinity is that of the landmark features, so degrees and eigenvectors come from sums over the rows.
    """
    found = fit_kernel_map(df, vector, "rbf", gamma, landmarks=landmarks, seed=seed)
    mapped = cut(found.transform(df, vector, "mapped"), "mapped")
    total = np.array(vector_sums(mapped, "mapped").first().s)

    def scaled(z: np.ndarray) -> np.ndarray:
        """Features over the root of the degree, and in the last place that root; a row far from all landmarks has next to none."""
        root = np.sqrt(np.maximum(z @ total, 1e-12))[:, None]
        return np.hstack([z / root, root])

    rows = cut(map_vectors(mapped, "mapped", "scaled", scaled).drop("mapped"), "scaled")
    values, vectors = np.linalg.eigh(gram(rows, "scaled")[:-1, :-1])
    top = np.argsort(values)[::-1][:k]
    axes = vectors[:, top] / np.sqrt(np.maximum(values[top], 1e-300))
    return map_vectors(rows, "scaled", output, lambda z: z[:, :-1] @ axes / z[:, -1:]).drop("scaled")
