"""Ranks and running totals over whole tables without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from corvane.functions.keyed_random import uniform
from corvane.lineage import cut


def running_totals(df: DataFrame, order: Sequence[Column], values: Sequence[str]) -> DataFrame:
    """Add ``<value>_total``, the inclusive running sum in the given order.

    Rows are range partitioned and summed within their range; every range is then shifted by
    the totals of the ranges before it. Only those totals, one row per partition, meet in one task.
    """
    ranged = cut(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()), "ranges")
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        ranged.groupBy("__part")
        .agg(*[F.sum(v).alias(v) for v in values])
        .select("__part", *[F.coalesce(F.sum(v).over(before), F.lit(0)).alias(f"__{v}") for v in values])
    )
    inside = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    # bounded: one row per shuffle partition
    return (
        ranged.join(F.broadcast(shifts), "__part")
        .withColumns({f"{v}_total": F.sum(v).over(inside) + F.col(f"__{v}") for v in values})
        .drop("__part", *[f"__{v}" for v in values])
    )


def top_rows(df: DataFrame, value: str, key: str, n: int) -> DataFrame:
    """The n rows of highest ``value``, ties by lowest ``key``, whatever share of the table n is.

    Distinct values are counted and their running totals tell where the cut falls. Rows above it are kept as they
    are; only the rows at the cut are ranked by key.
    """
    counts = df.groupBy(F.col(value).alias("__v")).agg(F.count("*").alias("__n"))
    upto = running_totals(counts, [F.col("__v").desc()], ["__n"]).where(F.col("__n_total") - F.col("__n") < n)
    kept = cut(upto.select("__v", (F.lit(n) - F.col("__n_total") + F.col("__n")).alias("__left"), (F.col("__n_total") > n).alias("__at")), "cuts")
    placed = df.join(kept, F.col(value) == F.col("__v"))
    tied = running_totals(placed.where("__at").withColumn("__one", F.lit(1)), [F.col(key)], ["__one"]).where("__one_total <= __left")
    return placed.where("not __at").select(*df.columns).unionByName(tied.select(*df.columns))


def hash_rank(
    df: DataFrame,
    keys: Sequence[str],
    seed: int,
    by: Sequence[str] = (),
    name: str = "rank",
    slices: int | None = None,
    total: str | None = None,
) -> DataFrame:
    """Add the 1-based rank of every row in a seeded random order, within the ``by`` columns.

    The draws are uniform, so slicing [0, 1) evenly splits even a single huge class: rows are
    ranked inside (class, slice) and shifted by the sizes of the slices before theirs. By default
    there are several slices per shuffle partition. ``total`` names a column for the class size.
    """
    slices = slices or max(1024, 8 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    drawn = df.withColumn("__u", uniform(seed, *keys)).withColumn(
        "__slice", F.floor(F.col("__u") * slices).cast("int")
    )
    part = [*by, "__slice"]
    whole = Window.partitionBy(*by)
    earlier = whole.orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    # one row per class and slice, written so that its size is known when the rows are joined
    shifts = cut(
        drawn.groupBy(*part).agg(F.count("*").alias("__n")).select(
            *[F.col(c).alias(f"__k{i}") for i, c in enumerate(part)],
            F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__shift"),
            F.sum("__n").over(whole).alias("__total"),
        ),
        "shifts",
    )
    inside = Window.partitionBy(*part).orderBy("__u", *keys)
    ranked = drawn.withColumn("__r", F.row_number().over(inside))
    match = F.lit(True)
    for i, c in enumerate(part):
        match = match & F.col(c).eqNullSafe(F.col(f"__k{i}"))
    return ranked.join(shifts, match).select(
        *df.columns,
        (F.col("__r") + F.col("__shift")).cast("bigint").alias(name),
        *([F.col("__total").alias(total)] if total else []),
    )
