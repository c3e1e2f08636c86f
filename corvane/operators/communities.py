"""Communities by local moving and contraction (Blondel et al., 2008) on edge tables."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame, functions as F

from corvane.lineage import cut
from corvane.operators.graph_stats import modularity, symmetric
from corvane.operators.ranking import running_totals


def _local_moves(both, labels, two_m: float, resolution: float, half: int, seed: int) -> DataFrame:
    """Move one hashed half of the nodes to the neighbouring community with the best gain.

    Only half of the nodes move at a time, and a lone node joins another lone node only towards
    the lower label (Lu et al., 2015), so that two neighbours cannot keep swapping.
    ``labels`` is (id, community, k) with the degree k.
    """
    totals = labels.groupBy("community").agg(F.sum("k").alias("tot"), F.count("*").alias("n"))
    toward = both.join(labels.select(F.col("id").alias("dst"), "community"), "dst").select(
        F.col("src").alias("id"), "community", "w"
    )
    stay = labels.select("id", "community", F.lit(0.0).alias("w"))
    options = (
        toward.unionByName(stay)
        .groupBy("id", "community")
        .agg(F.sum("w").alias("k_in"))
        .join(totals, "community")
        .join(labels.select("id", "k", F.col("community").alias("own")), "id")
    )
    home = F.col("community") == F.col("own")
    others = F.col("tot") - F.when(home, F.col("k")).otherwise(0.0)
    gain = F.round(F.col("k_in") - F.lit(resolution) * F.col("k") * others / F.lit(two_m), 9)
    best = options.withColumn("gain", gain).groupBy("id").agg(
        F.min(F.struct((-F.col("gain")).alias("loss"), F.col("community"), F.col("n"))).alias("best"),
        F.max(F.when(home, F.struct("gain", "own", "k", "n"))).alias("stay"),
    )
    swaps = (F.col("best.n") == 1) & (F.col("stay.n") == 1) & (F.col("best.community") > F.col("stay.own"))
    turn = F.pmod(F.xxhash64(F.lit(seed), F.col("id")), F.lit(2)) == half
    moves = (-F.col("best.loss") > F.col("stay.gain")) & ~swaps & turn
    return best.select(
        "id",
        F.when(moves, F.col("best.community")).otherwise(F.col("stay.own")).alias("community"),
        F.col("stay.k").alias("k"),
    )


def _score(edges, labels, resolution) -> float:
    return modularity(edges, labels, "w", resolution).first()[0] or 0.0


def louvain(
    nodes: DataFrame,
    edges: DataFrame,
    weight: str | None = None,
    resolution: float = 1.0,
    max_levels: int | None = None,
    max_rounds: int | None = None,
    min_gain: float = 1e-7,
    seed: int = 7,
) -> DataFrame:
    """Community of every node at every level, as (id, level, community).

    The best labels seen are kept, so modularity never falls from one level to the next; a level
    ends when a round gains less than ``min_gain``, and the last level is the one that gains
    nothing. ``max_levels`` and ``max_rounds`` end it earlier for a caller who asks for that.
    """
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    level_edges = cut(edges.select("src", "dst", w.alias("w")), "edges")
    member = cut(nodes.select("id", F.col("id").alias("community")), "labels")
    two_m = 2.0 * (level_edges.agg(F.sum("w")).first()[0] or 0.0)
    found = member.withColumn("level", F.lit(0))
    if two_m == 0:
        return found.select("id", "level", "community")

    level_nodes = member.select("id")
    quality = _score(level_edges, member, resolution)
    for level in count(1) if max_levels is None else range(1, max_levels + 1):
        both = cut(symmetric(level_edges.filter("src <> dst")), "both")
        ends = symmetric(level_edges).groupBy(F.col("src").alias("id")).agg(F.sum("w").alias("k"))
        labels = best = cut(
            level_nodes.join(ends, "id", "left").select(
                "id", F.col("id").alias("community"), F.coalesce("k", F.lit(0.0)).alias("k")
            ),
            "labels",
        )
        best_quality = quality
        for turn in count() if max_rounds is None else range(max_rounds):
            for half in (0, 1):
                labels = cut(_local_moves(both, labels, two_m, resolution, half, seed + turn), "labels")
            now = _score(level_edges, labels, resolution)
            gained = now - best_quality
            if gained > 0:
                best, best_quality = labels, now
            if gained < min_gain:
                break
        if best_quality <= quality:
            break
        quality = best_quality
        member = cut(
            member.join(best.select(F.col("id").alias("community"), F.col("community").alias("next")), "community")
            .select("id", F.col("next").alias("community")),
            "member",
        )
        found = found.unionByName(member.withColumn("level", F.lit(level)))
        side = lambda end: best.select(F.col("id").alias(end), F.col("community").alias(f"{end}_c"))
        level_edges = cut(
            level_edges.join(side("src"), "src")
            .join(side("dst"), "dst")
            .groupBy(F.least("src_c", "dst_c").alias("src"), F.greatest("src_c", "dst_c").alias("dst"))
            .agg(F.sum("w").alias("w")),
            "edges",
        )
        level_nodes = best.select(F.col("community").alias("id")).distinct()
    return found.select("id", "level", "community")


def final_partition(levels: DataFrame) -> DataFrame:
    """Communities of the last level, numbered 0..n-1 by their smallest member."""
    last = levels.agg(F.max("level")).scalar()
    top = levels.filter(F.col("level") == last).select("id", "community")
    first = top.groupBy("community").agg(F.min("id").alias("first"), F.lit(1).cast("bigint").alias("one"))
    numbers = running_totals(first, [F.col("first")], ["one"]).select(
        "community", (F.col("one_total") - 1).alias("number")
    )
    return top.join(numbers, "community").select("id", F.col("number").alias("community"))
