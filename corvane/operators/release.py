"""Privacy-preserving release of person tables.

A class is the set of rows that agree on the quasi-identifiers. All tests read one row per
class, so the person rows are shuffled only to be pre-aggregated, and the rows that stay are
found by a semi join on the classes. Nulls form a class of their own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from corvane.lineage import cut
from corvane.operators.ranking import running_totals


def _same(left: str, right: str, columns: Sequence[str]) -> Column:
    condition = F.lit(True)
    for c in columns:
        condition = condition & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return condition


def keep_classes(df: DataFrame, classes: DataFrame, qi: Sequence[str]) -> DataFrame:
    """The rows whose class is listed.

    The classes are written first, so that Spark knows their size when it plans: a small table is
    broadcast and the rows stay where they are, a large one is joined by shuffle.
    """
    listed = cut(classes.select(*qi), "classes")
    return df.alias("r").join(listed.alias("c"), _same("r", "c", qi), "left_semi")


def drop_classes(df: DataFrame, classes: DataFrame, qi: Sequence[str]) -> DataFrame:
    """The rows whose class is not listed."""
    listed = cut(classes.select(*qi), "classes")
    return df.alias("r").join(listed.alias("c"), _same("r", "c", qi), "left_anti")


def class_sizes(df: DataFrame, qi: Sequence[str], sensitive: str | None = None) -> DataFrame:
    """Rows per class, smallest class first."""
    keys = [*qi, *([sensitive] if sensitive else [])]
    return df.groupBy(*keys).agg(F.count("*").alias("n")).orderBy("n", *keys)


def attach_class_size(df: DataFrame, qi: Sequence[str]) -> DataFrame:
    """Every row with the size of its class."""
    sizes = cut(df.groupBy(*qi).agg(F.count("*").alias("class_size")), "classes")
    return df.alias("r").join(sizes.alias("c"), _same("r", "c", qi)).select("r.*", "c.class_size")


def class_histogram(df: DataFrame, qi: Sequence[str], sensitive: str, weighting: str = "count") -> DataFrame:
    """Rows per class and sensitive value; ``presence`` counts every value once."""
    n = F.count("*") if weighting == "count" else F.lit(1).cast("bigint")
    return df.groupBy(*qi, sensitive).agg(n.alias("n"))


def k_anonymous(df: DataFrame, qi: Sequence[str], k: int = 2) -> DataFrame:
    small = df.groupBy(*qi).agg(F.count("*").alias("n")).filter(F.col("n") < k)
    return drop_classes(df, small, qi)


def l_diverse(df: DataFrame, qi: Sequence[str], sensitive: str, l: int = 2) -> DataFrame:
    uniform = (
        class_histogram(df, qi, sensitive).groupBy(*qi).agg(F.count("*").alias("d")).filter(F.col("d") < l)
    )
    return drop_classes(df, uniform, qi)


def distribution(df: DataFrame, sensitive: str) -> DataFrame:
    """Share of every sensitive value in the table."""
    return _shares(df.groupBy(sensitive).agg(F.count("*").alias("n")), sensitive)


def _shares(counts: DataFrame, sensitive: str) -> DataFrame:
    total = counts.agg(F.sum("n")).scalar()
    return counts.select(sensitive, "n", (F.col("n") / total).alias("share"))


def _divergence(n: Column, share: Column) -> Column:
    """Sum of p ln(p/q) over the rows of a group, with p = n / sum(n)."""
    gap = F.when(share.isNull() | (share <= 0), F.lit(float("inf"))).otherwise(F.ln(n) - F.ln(share))
    return F.sum(n * gap) / F.sum(n) - F.ln(F.sum(n))


def class_stats(
    df: DataFrame,
    qi: Sequence[str],
    sensitive: str,
    baseline: DataFrame | None = None,
    weighting: str = "count",
) -> DataFrame:
    """Size, distinct sensitive values and divergence from the baseline, per class."""
    histogram = class_histogram(df, qi, sensitive)
    weighted = histogram.withColumn("w", F.col("n") if weighting == "count" else F.lit(1).cast("bigint"))
    # the table's own distribution is a sum over the same histogram, whose shuffle Spark reuses
    base = baseline
    if base is None:
        base = _shares(histogram.groupBy(sensitive).agg(F.sum("n").alias("n")), sensitive)
    joined = weighted.alias("r").join(
        base.select(F.col(sensitive), "share").alias("c"), _same("r", "c", [sensitive]), "left"
    )
    return joined.groupBy(*[F.col(f"r.{c}") for c in qi]).agg(
        F.sum("r.n").alias("n"),
        F.count("*").alias("n_distinct"),
        _divergence(F.col("r.w"), F.col("c.share")).alias("kl"),
    )


def kl_extremes(stats: DataFrame, qi: Sequence[str]) -> DataFrame:
    """The classes nearest to and farthest from the baseline; ties go to the lowest class."""
    near = F.struct(F.col("kl"), *[F.col(c) for c in qi])
    far = F.struct((-F.col("kl")).alias("kl"), *[F.col(c) for c in qi])
    ends = stats.agg(F.min(near).alias("near"), F.min(far).alias("far"))
    pick = lambda side, sign: ends.select(
        F.lit(side).alias("side"), *[F.col(f"{side}.{c}") for c in qi], (F.col(f"{side}.kl") * sign).alias("kl")
    )
    return pick("near", F.lit(1.0)).unionByName(pick("far", F.lit(-1.0)))


def t_close(
    df: DataFrame,
    qi: Sequence[str],
    sensitive: str,
    t: float = 0.5,
    baseline: DataFrame | None = None,
    weighting: str = "count",
) -> DataFrame:
    """Drop the classes that diverge by more than ``t``."""
    far = class_stats(df, qi, sensitive, baseline, weighting).filter(F.col("kl") > t)
    return drop_classes(df, far, qi)


def release(
    df: DataFrame,
    qi: Sequence[str],
    sensitive: str,
    k: int,
    l: int,
    t: float,
    baseline: DataFrame | None = None,
    weighting: str = "count",
) -> DataFrame:
    """All three tests in one pass: each removes whole classes, so one class table serves all."""
    stats = class_stats(df, qi, sensitive, baseline, weighting)
    kept = stats.filter((F.col("n") >= k) & (F.col("n_distinct") >= l) & (F.col("kl") <= t))
    return keep_classes(df, kept, qi)


def table_divergence(df: DataFrame, sensitive: str, baseline: DataFrame) -> DataFrame:
    """Divergence of a whole table from the baseline, matched by value."""
    counts = df.groupBy(sensitive).agg(F.count("*").alias("n"))
    joined = counts.alias("r").join(
        baseline.select(F.col(sensitive), "share").alias("c"), _same("r", "c", [sensitive]), "left"
    )
    return joined.agg(_divergence(F.col("r.n"), F.col("c.share")).alias("kl"))


def entropy(df: DataFrame, qi: Sequence[str]) -> DataFrame:
    """Shannon entropy of the class sizes, natural logarithm."""
    sizes = df.groupBy(*qi).agg(F.count("*").alias("n"))
    n = F.sum("n")
    return sizes.agg((F.ln(n) - F.sum(F.col("n") * F.ln("n")) / n).alias("entropy"))


def entropy_loss(
    before: DataFrame, after: DataFrame, qi_before: Sequence[str], qi_after: Sequence[str] | None = None
) -> DataFrame:
    old = entropy(before, qi_before).withColumn("side", F.lit("before"))
    new = entropy(after, qi_after or qi_before).withColumn("side", F.lit("after"))
    value = lambda side: F.max(F.when(F.col("side") == side, F.col("entropy")))
    return old.unionByName(new).agg(
        value("before").alias("entropy_before"),
        value("after").alias("entropy_after"),
        (value("before") - value("after")).alias("loss"),
    )


def privacy_grid(
    df: DataFrame, qi: Sequence[str], sensitive: str, k_max: int = 11, l_max: int = 11
) -> DataFrame:
    """Rows left for every k and l, from one class table.

    Sizes and distinct counts beyond the grid count as its edge, so at most
    ``k_max * l_max`` cells are spread over the thresholds they pass.
    """
    classes = (
        class_histogram(df, qi, sensitive)
        .groupBy(*qi)
        .agg(F.sum("n").alias("n"), F.count("*").alias("d"))
    )
    cells = classes.groupBy(
        F.least(F.col("n"), F.lit(k_max)).alias("kn"), F.least(F.col("d"), F.lit(l_max)).alias("ld")
    ).agg(F.sum("n").alias("n"))
    passed = cells.select(F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("kn"))).alias("k"), "ld", "n").select(
        "k", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("ld"))).alias("l"), "n"
    )
    grid = df.sparkSession.range(k_max * l_max).select(
        (F.floor(F.col("id") / l_max) + 1).alias("k"), (F.col("id") % l_max + 1).alias("l")
    )
    return (
        grid.join(passed.groupBy("k", "l").agg(F.sum("n").alias("n")), ["k", "l"], "left")
        .select("k", "l", F.coalesce("n", F.lit(0)).alias("rows_left"))
    )


def label_codes(df: DataFrame, column: str) -> DataFrame:
    """Code 0..n-1 of every distinct value, in sorted order."""
    values = df.select(column).distinct().withColumn("one", F.lit(1).cast("bigint"))
    return running_totals(values, [F.col(column)], ["one"]).select(
        column, (F.col("one_total") - 1).alias("code")
    )


def label_encode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace every column by its codes."""
    for c in columns:
        codes = cut(label_codes(df, c).withColumnRenamed(c, "__value"), "codes")
        df = (
            df.alias("r")
            .join(codes.alias("c"), F.col(f"r.{c}").eqNullSafe(F.col("c.__value")), "left")
            .select(*[F.col("c.code").alias(x) if x == c else F.col(f"r.{x}") for x in df.columns])
        )
    return df
