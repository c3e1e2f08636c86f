"""Connected components of an edge table by alternating large and small stars, on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corvane.lineage import cut


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Each node's neighbours are tied to the smallest of them and itself; only larger (or smaller) ones move."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both if large else both.where("b < a")
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    joined = near.join(least, "a")
    if large:
        moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            joined.select("a", F.col("m").alias("b"))
        )
    return moved.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each end of an edge (a, b) can reach.

    A hub's neighbours are combined before the shuffle or joined, never collected.  The number of rounds grows with
    the logarithm of the longest path in practice.
    """
    edges = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        edges = cut(_star(_star(edges, True), False), "edges")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots).distinct()


def follow(parents: DataFrame) -> DataFrame:
    """(node, component) of a forest given by one smaller parent (a) for each node (b), by pointer jumping."""
    roots = parents.select(F.col("a").alias("node")).join(parents.select(F.col("b").alias("node")), "node", "left_anti").distinct()
    labels = parents.select(F.col("b").alias("node"), F.col("a").alias("component"))
    labels = cut(labels.unionByName(roots.withColumn("component", F.col("node"))), "labels")
    while True:
        up = labels.select(F.col("node").alias("component"), F.col("component").alias("up"))
        jumped = cut(labels.join(up, "component").select("node", F.col("up").alias("component"), (F.col("up") != F.col("component")).alias("moved")), "labels")
        labels = jumped.select("node", "component")
        if jumped.where("moved").isEmpty():
            return labels


def across(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose ends lie in different components, with those components."""
    end = lambda c: labels.select(F.col("node").alias(c), F.col("component").alias(f"in_{c}"))
    placed = pairs.join(end("a"), "a", "left").join(end("b"), "b", "left")
    roots = [F.coalesce(f"in_{c}", c).alias(f"in_{c}") for c in "ab"]
    return placed.select("a", "b", *roots).where("in_a <> in_b")


def extend(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` after more links (a, b): only components are joined, whatever the number of their members."""
    edges = cut(across(links, labels).select(F.col("in_a").alias("a"), F.col("in_b").alias("b")).distinct(), "edges")
    if edges.isEmpty():
        return labels
    moved = components(edges).select(F.col("node").alias("component"), F.col("component").alias("into"))
    new = moved.select(F.col("component").alias("node"), "component")
    every = labels.unionByName(new).distinct()
    return cut(every.join(moved, "component", "left").select("node", F.coalesce("into", "component").alias("component")), "labels")
