"""k-shells by repeated h-index of the neighbours (Lü et al., 2016; Montresor et al., 2013)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from corvane.lineage import cut
from corvane.operators.graph_stats import symmetric


def _round(both: DataFrame, core: DataFrame) -> DataFrame:
    """h-index of the neighbours' values.

    Equal values are counted before they are ranked, so a hub costs as many rows as its
    neighbours have distinct values, which is at most twice the root of the edge count.
    """
    seen = both.join(core.withColumnRenamed("src", "dst"), "dst").groupBy("src", "core").agg(F.count("*").alias("n"))
    down = Window.partitionBy("src").orderBy(F.col("core").desc()).rowsBetween(Window.unboundedPreceding, 0)
    ranked = seen.withColumn("at_least", F.sum("n").over(down))
    return ranked.groupBy("src").agg(F.max(F.least("at_least", "core")).alias("core"))


def k_shells(nodes: DataFrame, edges: DataFrame, rounds_per_cut: int = 3) -> DataFrame:
    """The shell of every node: the largest k for which it survives peeling nodes of degree < k."""
    both = cut(symmetric(edges.select("src", "dst")), "edges")
    core = cut(both.groupBy("src").agg(F.count("*").alias("core")), "core")
    # values only fall, so an unchanged sum means that nothing changed
    total = core.agg(F.sum("core")).first()[0]
    while total:
        for _ in range(rounds_per_cut):
            core = _round(both, core)
        core = cut(core, "core")
        before, total = total, core.agg(F.sum("core")).first()[0]
        if before == total:
            break
    return nodes.select("id").join(core.withColumnRenamed("src", "id"), "id", "left").select(
        "id", F.coalesce("core", F.lit(0).cast("bigint")).alias("shell")
    )


def shell_table(shells: DataFrame) -> DataFrame:
    """Size of every shell from 0 to the highest, empty shells included."""
    sizes = shells.groupBy("shell").agg(F.count("*").alias("n"))
    highest = sizes.agg(F.sequence(F.lit(0).cast("bigint"), F.max("shell")).alias("all"))
    every = highest.select(F.explode("all").alias("shell"))
    return every.join(sizes, "shell", "left").select("shell", F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))
