"""Feature columns, splits, sampling and scaling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import MinMaxScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from corvane.functions.keyed_random import uniform
from corvane.operators.ranking import hash_rank


def feature_columns(df: DataFrame, *not_features: str) -> list[str]:
    return [c for c in df.columns if c not in not_features]


def assemble(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=output).transform(df)


def with_label(df: DataFrame, column: str, value: int) -> DataFrame:
    return df.withColumn(column, F.lit(value).cast("int"))


def union_splits(train: DataFrame, test: DataFrame, column: str = "split") -> DataFrame:
    """One table that remembers where each row came from."""
    return train.withColumn(column, F.lit("train")).unionByName(test.withColumn(column, F.lit("test")))


def only_split(df: DataFrame, value: str, column: str = "split") -> DataFrame:
    return df.filter(F.col(column) == value).drop(column)


def shuffled(df: DataFrame, keys: Sequence[str], seed: int) -> DataFrame:
    """Rows with their position in a seeded random order."""
    return hash_rank(df, keys, seed, name="position")


def sample_rows(df: DataFrame, keys: Sequence[str], n: int, seed: int, few: int = 1000) -> DataFrame:
    """Exactly ``n`` rows (or all of them), without replacement.

    A few rows are a top-n, which Spark cuts in every task; more are cut by rank.
    """
    if n <= few:
        drawn = df.withColumn("__u", uniform(seed, *keys))
        return drawn.orderBy("__u", *keys).limit(n).drop("__u")
    return hash_rank(df, keys, seed).filter(F.col("rank") <= n).drop("rank")


def stratified_holdout(
    df: DataFrame, keys: Sequence[str], label: str, fraction: float, seed: int, rounding: str = "even"
) -> DataFrame:
    """Mark a fraction of every class as ``test``, the complement as ``train``.

    ``even`` rounds the size of the test part half to even, ``up`` rounds it up.
    """
    wanted = F.col("__class_n") * F.lit(fraction)
    wanted = F.bround(wanted) if rounding == "even" else F.ceil(wanted)
    ranked = hash_rank(df, keys, seed, by=[label], total="__class_n")
    return ranked.select(*df.columns, F.when(F.col("rank") <= wanted, "test").otherwise("train").alias("split"))


def assign_folds(df: DataFrame, keys: Sequence[str], folds: int, seed: int) -> DataFrame:
    """Shuffled folds whose sizes differ by at most one."""
    return hash_rank(df, keys, seed).select(
        *df.columns, ((F.col("rank") - 1) % folds).cast("int").alias("fold")
    )


def oversample(
    df: DataFrame, keys: Sequence[str], label: str, minority, other, seed: int, by: Sequence[str] = ()
) -> DataFrame:
    """Repeat rows of one class until it matches the other; no row is repeated more than once.

    ``copy`` is 0 for original rows and 1 for repeats, so (key, copy) stays a key.  A class that is
    already the larger one is left as it is.
    """
    groups = [F.col(c).alias(f"__by{i}") for i, c in enumerate(by)]
    sizes = df.groupBy(*groups).agg(
        F.count_if(F.col(label) == F.lit(minority)).alias("n0"),
        F.count_if(F.col(label) == F.lit(other)).alias("n1"),
    )
    missing = F.least(F.greatest(F.col("n1") - F.col("n0"), F.lit(0)), F.col("n0"))
    ranked = hash_rank(df.filter(F.col(label) == F.lit(minority)), keys, seed, by=by)
    if by:
        match = F.lit(True)
        for i, c in enumerate(by):
            match = match & F.col(c).eqNullSafe(F.col(f"__by{i}"))
        extra = ranked.join(sizes, match).filter(F.col("rank") <= missing)
    else:
        extra = ranked.filter(F.col("rank") <= sizes.select(missing).scalar())
    kept = df.filter(F.col(label).isin(minority, other))
    return kept.withColumn("copy", F.lit(0)).unionByName(
        extra.select(*df.columns).withColumn("copy", F.lit(1))
    )


def fit_minmax(train: DataFrame, column: str = "features", output: str = "scaled"):
    """Scaler to [0, 1], fitted on the training rows only."""
    return MinMaxScaler(inputCol=column, outputCol=output).fit(train)


def clipped(df: DataFrame, column: str) -> DataFrame:
    """Scaled vectors held inside [0, 1]; unseen rows can lie outside the range of the training rows."""
    held = F.transform(vector_to_array(column), lambda x: F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0)))
    return df.withColumn(column, array_to_vector(held))


def scaled_columns(df: DataFrame, columns: Sequence[str], train: Column | None = None) -> DataFrame:
    """Scale plain columns to [0, 1] by the range of the training rows; a constant column gives 0."""
    inside = F.lit(True) if train is None else train
    low = {c: F.min(F.when(inside, F.col(c))).alias(f"{c}_lo") for c in columns}
    high = {c: F.max(F.when(inside, F.col(c))).alias(f"{c}_hi") for c in columns}
    ranges = df.agg(F.struct(*low.values(), *high.values()).alias("r"))
    out = df.withColumn("__r", ranges.scalar())
    for c in columns:
        lo, hi = F.col(f"__r.{c}_lo"), F.col(f"__r.{c}_hi")
        out = out.withColumn(c, F.when(hi == lo, F.lit(0.0)).otherwise((F.col(c) - lo) / (hi - lo)))
    return out.drop("__r")


def concat_keyed(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Columns of two tables side by side, matched by key."""
    return left.join(right, key)
