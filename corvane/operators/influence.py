"""Influence spread under independent cascades, and the choice of seed sets.

All runs of all strategies advance together: a step is one join of the frontier with the edges.
Every ordered pair has one coin per run, fixed by a hash of (seed, run, src, dst), which is the
live-edge form of the process (Kempe et al., 2003).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from corvane.functions.keyed_random import uniform
from corvane.lineage import GrowingTable, cut
from corvane.operators.features import sample_rows
from corvane.operators.graph_stats import degrees, symmetric
from corvane.operators.ranking import hash_rank, top_rows

FEW = 10_000  # rows that one task may merge


def seed_count(share: float, population: int) -> int:
    return math.ceil(share * population)


def spread(edges: DataFrame, starts: DataFrame, p: float, seed: int, max_steps: int | None = None) -> DataFrame:
    """Step at which every node is reached, from ``starts(strategy, run, id)``."""
    spark = edges.sparkSession
    both = cut(symmetric(edges.select("src", "dst")), "edges")
    key = ["strategy", "run", "id"]
    first = starts.select(*key).distinct().withColumn("step", F.lit(0))
    reached = GrowingTable(spark, "reached", first.schema)
    frontier = reached.append(first)
    step = 0
    while not frontier.isEmpty() and (max_steps is None or step < max_steps):
        step += 1
        tried = frontier.withColumnRenamed("id", "src").join(both, "src")
        infected = (
            tried.filter(uniform(seed, "run", "src", "dst") < p)
            .select("strategy", "run", F.col("dst").alias("id"))
            .distinct()
            .join(reached.read().select(*key), key, "left_anti")
        )
        frontier = reached.append(infected.withColumn("step", F.lit(step)))
    return reached.read()


def cascades(
    edges: DataFrame, seeds: DataFrame, p: float, runs: int, seed: int, max_steps: int | None = None
) -> DataFrame:
    """``runs`` cascades from every seed set ``seeds(strategy, id)``."""
    starts = seeds.select("strategy", F.explode(F.sequence(F.lit(1), F.lit(runs))).alias("run"), "id")
    return spread(edges, starts, p, seed, max_steps)


def cascade_series(reached: DataFrame) -> DataFrame:
    """New and cumulative infections per run and step, every run carried to the longest one."""
    new = reached.groupBy("strategy", "run", "step").agg(F.count("*").alias("new"))
    longest = new.agg(F.max("step")).scalar()
    steps = (
        new.select("strategy", "run")
        .distinct()
        .withColumn("last", longest)
        .select("strategy", "run", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("step"))
    )
    so_far = Window.partitionBy("strategy", "run").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    return (
        steps.join(new, ["strategy", "run", "step"], "left")
        .withColumn("new", F.coalesce("new", F.lit(0).cast("bigint")))
        .withColumn("infected", F.sum("new").over(so_far))
    )


def mean_curve(series: DataFrame) -> DataFrame:
    """Mean cumulative infections per strategy and step."""
    return series.groupBy("strategy", "step").agg(F.avg("infected").alias("mean_infected"))


def strategy_stats(reached: DataFrame) -> DataFrame:
    """Mean and population variance of the final size, and the longest run, per strategy."""
    runs = reached.groupBy("strategy", "run").agg(F.count("*").alias("size"), F.max("step").alias("steps"))
    return runs.groupBy("strategy").agg(
        F.avg("size").alias("mean_size"), F.var_pop("size").alias("var_size"), F.max("steps").alias("longest")
    )


def random_seeds(nodes: DataFrame, n: int, seed: int) -> DataFrame:
    return sample_rows(nodes.select("id"), ["id"], n, seed)


def top_degree_seeds(nodes: DataFrame, edges: DataFrame, n: int) -> DataFrame:
    """The n nodes of highest degree, ties by id; an n that grows with the graph is cut off without a single task."""
    found = degrees(nodes, edges)
    if n <= FEW:
        return found.orderBy(F.col("degree").desc(), "id").limit(n)
    return top_rows(cut(found, "degrees"), "degree", "id", n)


def greedy_frontier_seeds(nodes: DataFrame, edges: DataFrame, n: int, batch: int = 1000) -> DataFrame:
    """Start at the highest degree, then add the highest-degree neighbour of the chosen set.

    The boundary is a table that grows by the unseen neighbours of the last picks. A round takes the best ``batch``
    nodes of the boundary in order, up to the first that an unseen neighbour of those before it would overtake, so
    a round makes one pick only where each pick opens a better one. ``batch`` bounds a round and changes no result.
    """
    ranked = cut(degrees(nodes, edges), "degrees")
    ends = ranked.withColumnRenamed("id", "dst")
    reach = cut(symmetric(edges.select("src", "dst")).join(ends, "dst").select("src", "dst", "degree"), "edges")
    best_first = [F.col("degree").desc(), F.col("id")]
    standing = lambda key: F.struct((-F.col("degree")).alias("d"), F.col(key).alias("id"))
    seen = GrowingTable(nodes.sparkSession, "seen", ranked.schema)
    chosen = GrowingTable(nodes.sparkSession, "chosen", ranked.withColumn("rank", F.lit(1)).schema)
    picked = chosen.append(ranked.orderBy(*best_first).limit(1).withColumn("rank", F.lit(1)))
    seen.append(picked.select("id", "degree"))
    done = added = picked.count()
    # at most batch rows meet in each of these windows
    in_order, before = Window.orderBy(*best_first), Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    while added and done < n:
        last = picked.select(F.col("id").alias("src"))
        fresh = reach.join(last, "src", "left_semi").select(F.col("dst").alias("id"), "degree").distinct()
        seen.append(fresh.join(seen.read(), "id", "left_anti"))
        known = seen.read().select("id")
        front = seen.read().join(chosen.read().select("id"), "id", "left_anti").orderBy(*best_first).limit(min(batch, n - done))
        front = cut(front.withColumn("place", F.row_number().over(in_order)), "front")
        beyond = reach.join(front.select(F.col("id").alias("src"), "place"), "src").join(
            known.withColumnRenamed("id", "dst"), "dst", "left_anti"
        )
        opened = beyond.groupBy("place").agg(F.min(standing("dst")).alias("opened"))
        judged = front.join(opened, "place", "left").withColumn("rival", F.min("opened").over(before))
        sure = judged.filter(F.col("rival").isNull() | (standing("id") < F.col("rival")))
        picked = chosen.append(sure.select("id", "degree", (F.col("place") + done).alias("rank")))
        added = picked.count()
        done += added
    return chosen.read().select("rank", "id", "degree")


def reverse_reachable_sets(nodes: DataFrame, edges: DataFrame, p: float, samples: int, seed: int) -> DataFrame:
    """For uniformly drawn targets, the nodes that would reach them: (run, id)."""
    numbered = hash_rank(nodes.select("id"), ["id"], seed)
    drawn = (
        nodes.sparkSession.range(1, samples + 1)
        .withColumn("n", nodes.agg(F.count("*")).scalar())
        .select(
            F.col("id").cast("int").alias("run"),
            (F.floor(uniform(seed + 1, "id") * F.col("n")) + 1).cast("bigint").alias("rank"),
        )
    )
    targets = drawn.join(numbered, "rank").select(F.lit("target").alias("strategy"), "run", "id")
    return spread(edges, targets, p, seed).select("run", "id")


def max_influence(
    nodes: DataFrame, edges: DataFrame, n_seeds: int, p: float = 0.1, samples: int = 2000, seed: int = 1
) -> DataFrame:
    """Seed set of near-maximal spread by covering reverse-reachable sets (Borgs et al., 2014).

    One sampling serves all ranks. Returns (rank, id, est_spread), the spread of the first
    ``rank`` seeds together.
    """
    left = cut(reverse_reachable_sets(nodes, edges, p, samples, seed), "sets")
    population = nodes.agg(F.count("*")).scalar()
    schema = "rank int, id {}, covered bigint".format(nodes.schema["id"].dataType.simpleString())
    chosen = GrowingTable(nodes.sparkSession, "chosen", nodes.sparkSession.createDataFrame([], schema).schema)
    for rank in range(1, n_seeds + 1):
        best = left.groupBy("id").agg(F.count("*").alias("covered")).orderBy(F.col("covered").desc(), "id").limit(1)
        added = chosen.append(best.select(F.lit(rank).alias("rank"), "id", "covered"))
        if added.isEmpty():
            break
        hit = left.join(added.select("id"), "id", "left_semi").select("run")
        left = cut(left.join(hit, "run", "left_anti"), "sets")
    return _with_estimates(chosen.read(), population, samples)


def _with_estimates(chosen: DataFrame, population: Column, samples: int) -> DataFrame:
    # one row per chosen seed
    so_far = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    return chosen.withColumn("__n", population).select(
        "rank", "id", (F.sum("covered").over(so_far) * F.col("__n") / F.lit(float(samples))).alias("est_spread")
    )


def max_influence_simulated(
    nodes: DataFrame, edges: DataFrame, n_seeds: int, p: float = 0.1, runs: int = 100, seed: int = 1
) -> DataFrame:
    """Hill climbing by simulation: every candidate is a strategy of one joint cascade per rank."""
    ids = cut(nodes.select("id"), "nodes")
    schema = "rank int, id {}, est_spread double".format(ids.schema["id"].dataType.simpleString())
    chosen = GrowingTable(ids.sparkSession, "chosen", ids.sparkSession.createDataFrame([], schema).schema)
    for rank in range(1, n_seeds + 1):
        candidates = ids.select(F.col("id").alias("strategy"), "id")
        if rank > 1:
            have = chosen.read().select("id")
            candidates = candidates.join(have, "id", "left_anti")
            # bounded: the seeds chosen so far
            taken = have.agg(F.collect_list("id")).scalar()
            candidates = candidates.withColumn("__all", F.concat(F.array("id"), taken)).select(
                "strategy", F.explode("__all").alias("id")
            )
        sizes = cascades(edges, candidates, p, runs, seed).groupBy("strategy").agg(
            (F.count("*") / F.lit(float(runs))).alias("est_spread")
        )
        best = sizes.orderBy(F.col("est_spread").desc(), "strategy").limit(1)
        if chosen.append(best.select(F.lit(rank).alias("rank"), F.col("strategy").alias("id"), "est_spread")).isEmpty():
            break
    return chosen.read()
