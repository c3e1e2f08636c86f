"""Scoring of predictions and comparison of labelings.

Everything is computed from counts, which Spark combines before the shuffle; no pair of rows is
ever formed.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from corvane.lineage import cut
from corvane.operators.ranking import running_totals

METRICS = ("accuracy", "precision", "recall", "fscore", "bcr", "auc")


def confusion(df: DataFrame, truth: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """Counts of the four outcomes; 1 is the positive class."""
    t, p = F.col(truth) == 1, F.col(predicted) == 1
    return df.groupBy(*by).agg(
        F.count_if(t & p).alias("tp"),
        F.count_if(~t & p).alias("fp"),
        F.count_if(t & ~p).alias("fn"),
        F.count_if(~t & ~p).alias("tn"),
    )


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def metrics_from_confusion(counts: DataFrame, by: Sequence[str] = (), flip: bool = False) -> DataFrame:
    """Accuracy, precision, recall, F1, balanced rate and AUC of hard labels.

    With ``flip``, predictions that are wrong more often than right are read inverted.
    """
    if flip:
        swap = F.col("tp") + F.col("tn") < F.col("fp") + F.col("fn")
        pick = lambda a, b: F.when(swap, F.col(b)).otherwise(F.col(a)).alias(a)
        counts = counts.select(*by, pick("tp", "fn"), pick("fn", "tp"), pick("fp", "tn"), pick("tn", "fp"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    balanced = (_ratio(tp, tp + fn) + _ratio(tn, tn + fp)) / 2
    return counts.select(
        *by,
        _ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("fscore"),
        balanced.alias("bcr"),
        balanced.alias("auc"),
    )


def classification_metrics(
    df: DataFrame, truth: str, predicted: str, by: Sequence[str] = (), flip: bool = False
) -> DataFrame:
    return metrics_from_confusion(confusion(df, truth, predicted, by), by, flip)


def long_scores(wide: DataFrame, by: Sequence[str], metrics: Sequence[str] = METRICS) -> DataFrame:
    """One row per metric."""
    return wide.unpivot(list(by), list(metrics), "metric", "value")


def mean_scores(scores: DataFrame, by: Sequence[str]) -> DataFrame:
    """Mean over folds or runs."""
    return scores.groupBy(*by, "metric").agg(F.avg("value").alias("value"))


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("n"))


def roc_points(df: DataFrame, truth: str, score: str) -> DataFrame:
    """One point per distinct score, from the highest down."""
    grouped = df.groupBy(F.col(score).alias("threshold")).agg(
        F.count_if(F.col(truth) == 1).alias("tp"), F.count_if(F.col(truth) != 1).alias("fp")
    )
    totals = running_totals(grouped, [F.col("threshold").desc()], ["tp", "fp"])
    ends = totals.agg(F.struct(F.max("tp_total").alias("p"), F.max("fp_total").alias("n")).alias("e"))
    return totals.withColumn("e", ends.scalar()).select(
        "threshold",
        "tp",
        "fp",
        _ratio(F.col("fp_total"), F.col("e.n")).alias("fpr"),
        _ratio(F.col("tp_total"), F.col("e.p")).alias("tpr"),
    )


def auc(points: DataFrame) -> DataFrame:
    """Area under the curve by trapezoids between neighbouring points."""
    p, n = F.sum("tp"), F.sum("fp")
    # each point adds a slice of width fp/n whose mean height is the rate halfway through its step
    slices = F.sum(F.col("fp") * (F.col("tpr") * F.lit(1.0)))
    half = F.sum(F.col("fp") * F.col("tp")) / 2
    return points.agg(F.when(p * n == 0, F.lit(0.0)).otherwise(slices / n - half / (p * n)).alias("auc"))


def _pairs(n: Column) -> Column:
    n = n.cast("double")
    return n * (n - 1) / 2


def contingency(df: DataFrame, a: str, b: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count("*").alias("n"))


def pair_counts(table: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Pairs of rows together in both labelings, in each one, and in total."""
    table = cut(table, "counts")  # read four times
    both = table.groupBy(*by).agg(F.sum(_pairs(F.col("n"))).alias("v"), F.sum("n").alias("rows"))
    side = lambda c: table.groupBy(*by, c).agg(F.sum("n").alias("n")).groupBy(*by).agg(
        F.sum(_pairs(F.col("n"))).alias("v")
    )
    parts = [
        both.select(*by, F.lit("both").alias("part"), "v"),
        both.select(*by, F.lit("all").alias("part"), _pairs(F.col("rows")).alias("v")),
        side("a").select(*by, F.lit("a").alias("part"), "v"),
        side("b").select(*by, F.lit("b").alias("part"), "v"),
    ]
    pick = lambda name: F.max(F.when(F.col("part") == name, F.col("v")))
    return reduce(DataFrame.unionByName, parts).groupBy(*by).agg(
        pick("both").alias("both"), pick("a").alias("in_a"), pick("b").alias("in_b"), pick("all").alias("all")
    )


def adjusted_rand(table: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Adjusted Rand index (Hubert & Arabie, 1985) from a contingency table."""
    expected = F.when(F.col("all") == 0, F.lit(0.0)).otherwise(F.col("in_a") * F.col("in_b") / F.col("all"))
    top = (F.col("in_a") + F.col("in_b")) / 2
    return pair_counts(table, by).select(
        *by,
        F.when(top == expected, F.lit(1.0)).otherwise((F.col("both") - expected) / (top - expected)).alias("ari"),
    )


def pair_jaccard(table: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Share of the pairs together in either labeling that are together in both."""
    either = F.col("in_a") + F.col("in_b") - F.col("both")
    return pair_counts(table, by).select(
        *by,
        F.col("both").cast("bigint").alias("n11"),
        (F.col("in_a") - F.col("both")).cast("bigint").alias("n10"),
        (F.col("in_b") - F.col("both")).cast("bigint").alias("n01"),
        F.when(either != 0, F.col("both") / either).alias("jaccard"),
    )


def rand_matrix(df: DataFrame, labelings: Sequence[str]) -> DataFrame:
    """Adjusted Rand index of every ordered pair of label columns.

    Each row yields its label pairs directly, so nothing is joined, and the pairs are counted
    before the shuffle.
    """
    pairs = F.array(
        *[
            F.struct(
                F.lit(x).alias("left"),
                F.lit(y).alias("right"),
                F.col(x).cast("string").alias("la"),
                F.col(y).cast("string").alias("lb"),
            )
            for x in labelings
            for y in labelings
        ]
    )
    exploded = df.select(F.explode(pairs).alias("p")).select("p.*")
    return adjusted_rand(contingency(exploded, "la", "lb", ["left", "right"]), ["left", "right"])


def join_labelings(labelings: dict[str, DataFrame], key: str) -> DataFrame:
    """Labelings (key, label) side by side; all must cover the same keys."""
    named = [df.select(key, F.col("label").alias(name)) for name, df in labelings.items()]
    return reduce(lambda a, b: a.join(b, key), named)


def unmatched_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """How many keys are in only one of the two tables."""
    left = a.select(key).distinct().withColumn("__a", F.lit(1))
    right = b.select(key).distinct().withColumn("__b", F.lit(1))
    return left.join(right, key, "full_outer").agg(
        F.count_if(F.col("__b").isNull()).alias("left_only"),
        F.count_if(F.col("__a").isNull()).alias("right_only"),
    )


def require_same_keys(a: DataFrame, b: DataFrame, key: str) -> None:
    row = unmatched_keys(a, b, key).first()
    if row.left_only or row.right_only:
        raise ValueError(f"labelings differ: {row.left_only} keys only left, {row.right_only} only right")


def majority_label(neighbours: DataFrame, group: Sequence[str], label: str) -> DataFrame:
    """Most frequent label per group; ties go to the smallest label."""
    votes = neighbours.groupBy(*group, label).agg(F.count("*").alias("n"))
    return votes.groupBy(*group).agg(
        F.max_by(label, F.struct("n", (-F.col(label)).alias("tie"))).alias("majority"),
        F.max("n").alias("votes"),
    )
