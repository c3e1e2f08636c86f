"""Graphs of items that occur in the same group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from corvane.lineage import cut

TASK_PAIRS = 1_000_000  # what a task may hold while it combines equal pairs


def _pairs_of(df: DataFrame, members: str, *carry: str) -> DataFrame:
    """Unordered pairs of a sorted array, one member at a time so that no pair array is built."""
    size = F.size(members)
    return (
        df.filter(size > 1)
        .select(*carry, members, F.explode(F.sequence(F.lit(1), size - 1)).alias("__i"))
        .select(
            *carry,
            F.get(members, F.col("__i") - 1).alias("src"),
            F.explode(F.slice(members, F.col("__i") + 1, F.size(members) - F.col("__i"))).alias("dst"),
        )
    )


def _small_pairs(rows: DataFrame, pairs: int) -> DataFrame:
    """Pairs of the small groups in ``rows``, of which there are ``pairs``: a task yields about ``TASK_PAIRS`` before they are combined."""
    parts = max(rows.sparkSession.sparkContext.defaultParallelism, -(-pairs // TASK_PAIRS))
    return _pairs_of(rows.repartition(parts, "g").groupBy("g").agg(F.sort_array(F.collect_list("i")).alias("m")), "m")


def mention_edges(mentions: DataFrame, group: Sequence[str], entity: str = "entity") -> DataFrame:
    """Entities of one paragraph are linked; the weight is the number of shared paragraphs.

    Paragraphs with the same set of entities are counted before pairs are formed. A set holds
    at most the entities of the dictionary.
    """
    sets = mentions.groupBy(*group).agg(F.sort_array(F.collect_set(entity)).alias("members"))
    counted = sets.filter(F.size("members") > 1).groupBy("members").agg(F.count("*").alias("n"))
    return _pairs_of(counted, "members", "n").groupBy("src", "dst").agg(F.sum("n").alias("weight"))


def mention_nodes(mentions: DataFrame, entity: str = "entity") -> DataFrame:
    return mentions.select(F.col(entity).alias("id")).distinct()


def cooccurrence_edges(
    members: DataFrame, group: str, item: str, min_weight: int = 1, light: int = 256
) -> DataFrame:
    """Pairs of items that share at least ``min_weight`` groups, with the number they share.

    Groups of up to ``light`` items yield their pairs. Larger ones are joined by prefix
    filtering (Chaudhuri et al., 2006): a pair that meets in large groups only must share one
    outside the ``min_weight - 1`` largest groups of each item, so a single huge group yields
    no pairs. What is left of a large group is cut into blocks of at most ``light`` items, and
    the candidates are counted exactly by joins on their memberships. Rows without a group or
    without an item link nothing.
    """
    named = members.select(F.col(group).alias("g"), F.col(item).alias("i")).na.drop()
    rows = cut(named.distinct(), "members")
    sizes = rows.groupBy("g").agg(F.count("*").alias("n"))
    large = sizes.filter(F.col("n") > light)
    formed = F.when(F.col("n") <= light, F.col("n") * (F.col("n") - 1) / 2).otherwise(0).cast("bigint")
    n_large, n_pairs = sizes.agg(F.count_if(F.col("n") > light), F.coalesce(F.sum(formed), F.lit(0))).first()
    if not n_large:
        pairs = _small_pairs(rows, n_pairs)
        counted = pairs.groupBy("src", "dst").agg(F.count("*").alias("weight"))
        return counted.filter(F.col("weight") >= min_weight)

    large = cut(large, "large")
    small_rows = rows.join(large, "g", "left_anti")
    near = _small_pairs(small_rows, n_pairs)
    dense = cut(rows.join(large, "g"), "dense")
    far = _blocked_pairs(_without_largest(dense, min_weight - 1), light)
    candidates = cut(
        near.withColumn("n", F.lit(1).cast("bigint"))
        .unionByName(far.distinct().withColumn("n", F.lit(0).cast("bigint")))
        .groupBy("src", "dst")
        .agg(F.sum("n").alias("n_small")),
        "candidates",
    )
    shared = (
        candidates.join(dense.select(F.col("i").alias("src"), "g"), "src")
        .join(dense.select(F.col("i").alias("dst"), "g"), ["dst", "g"])
        .groupBy("src", "dst")
        .agg(F.count("*").alias("n_large"))
    )
    return (
        candidates.join(shared, ["src", "dst"], "left")
        .select("src", "dst", (F.col("n_small") + F.coalesce("n_large", F.lit(0))).alias("weight"))
        .filter(F.col("weight") >= min_weight)
    )


def _without_largest(dense: DataFrame, skip: int) -> DataFrame:
    if skip == 0:
        return dense
    largest = Window.partitionBy("i").orderBy(F.col("n").desc(), "g")
    skipped = dense.withColumn("r", F.row_number().over(largest)).filter(F.col("r") <= skip)
    return dense.join(skipped.select("i", "g"), ["i", "g"], "left_anti")


def _blocked_pairs(dense: DataFrame, light: int) -> DataFrame:
    """All pairs of every group, formed in tasks that see two blocks of the group each."""
    blocks = dense.groupBy("g").agg(F.ceil(F.count("*") / F.lit(light)).cast("int").alias("blocks"))
    placed = dense.select("g", "i").join(blocks, "g").withColumn(
        "b", F.pmod(F.xxhash64("i"), F.col("blocks")).cast("int")
    )
    spread = placed.select("g", "i", "b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o"))
    cells = spread.groupBy("g", F.least("b", "o").alias("lo"), F.greatest("b", "o").alias("hi")).agg(
        F.sort_array(F.collect_set(F.struct("i", "b"))).alias("m")
    )
    pairs = _pairs_of(cells, "m", "lo", "hi")
    crosses: Column = (F.col("lo") == F.col("hi")) | (F.col("src.b") != F.col("dst.b"))
    return pairs.filter(crosses).select(F.col("src.i").alias("src"), F.col("dst.i").alias("dst"))
