"""Statistics of undirected graphs kept as ``nodes(id)`` and ``edges(src, dst)`` with src < dst."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def symmetric(edges: DataFrame) -> DataFrame:
    """Both directions of every edge, from one scan of the edges."""
    carried = [c for c in edges.columns if c not in ("src", "dst")]
    both = F.array(
        F.struct(F.col("src").alias("src"), F.col("dst").alias("dst")),
        F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")),
    )
    return edges.select(F.explode(both).alias("e"), *carried).select("e.src", "e.dst", *carried)


def nodes_of(edges: DataFrame) -> DataFrame:
    return symmetric(edges.select("src", "dst")).select(F.col("src").alias("id")).distinct()


def neighbours(edges: DataFrame) -> DataFrame:
    return symmetric(edges.select("src", "dst")).select(F.col("src").alias("id"), F.col("dst").alias("neighbour"))


def degrees(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Degree of every node, 0 where it has no edge."""
    counted = neighbours(edges).groupBy("id").agg(F.count("*").alias("degree"))
    return nodes.select("id").join(counted, "id", "left").select(
        "id", F.coalesce("degree", F.lit(0).cast("bigint")).alias("degree")
    )


def by_degree(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    return degrees(nodes, edges).orderBy(F.col("degree").desc(), "id")


def degree_stats(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    return degrees(nodes, edges).agg(
        F.count("*").alias("n_nodes"),
        F.avg("degree").alias("mean_degree"),
        F.var_pop("degree").alias("var_degree"),
    )


def degree_assortativity(edges: DataFrame) -> DataFrame:
    """Correlation of the degrees at the two ends, every edge read both ways."""
    counted = neighbours(edges).groupBy("id").agg(F.count("*").alias("d"))
    ends = (
        edges.select("src", "dst")
        .join(counted.select(F.col("id").alias("src"), F.col("d").alias("ds")), "src")
        .join(counted.select(F.col("id").alias("dst"), F.col("d").alias("dd")), "dst")
    )
    both = symmetric(ends.select(F.col("ds").alias("src"), F.col("dd").alias("dst")))
    return both.agg(F.corr(F.col("src").cast("double"), F.col("dst").cast("double")).alias("assortativity"))


def induced_subgraph(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    ids = nodes.select("id")
    return edges.join(ids.withColumnRenamed("id", "src"), "src", "left_semi").join(
        ids.withColumnRenamed("id", "dst"), "dst", "left_semi"
    ).select(*edges.columns)


def edge_communities(edges: DataFrame, partition: DataFrame) -> DataFrame:
    """Every edge with the community of both ends."""
    side = lambda end, name: partition.select(F.col("id").alias(end), F.col("community").alias(name))
    return edges.join(side("src", "c_src"), "src").join(side("dst", "c_dst"), "dst")


def crossing_edges(edges: DataFrame, partition: DataFrame) -> DataFrame:
    return edge_communities(edges, partition).filter(F.col("c_src") != F.col("c_dst"))


def quotient_graph(edges: DataFrame, partition: DataFrame) -> DataFrame:
    """One edge per unordered pair of communities, weighted by the edges between them."""
    return (
        crossing_edges(edges, partition)
        .groupBy(F.least("c_src", "c_dst").alias("src"), F.greatest("c_src", "c_dst").alias("dst"))
        .agg(F.count("*").alias("weight"))
    )


def community_members(partition: DataFrame) -> DataFrame:
    """Members by community with its size; long form, so that no community is held in one row."""
    sizes = partition.groupBy("community").agg(F.count("*").alias("size"))
    return partition.join(sizes, "community").select("community", "size", "id")


def community_count(partition: DataFrame) -> DataFrame:
    return partition.agg(F.count_distinct("community").alias("n_communities"))


def modularity(edges: DataFrame, partition: DataFrame, weight: str | None = None, resolution: float = 1.0) -> DataFrame:
    """Share of edges inside communities minus its expectation; a self-loop counts twice in a degree."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    placed = edge_communities(edges, partition).select("c_src", "c_dst", w.alias("w"))
    ends = placed.select(
        F.explode(
            F.array(
                F.struct(
                    F.col("c_src").alias("c"),
                    F.when(F.col("c_src") == F.col("c_dst"), 2 * F.col("w")).otherwise(0.0).alias("inside"),
                    F.col("w"),
                ),
                F.struct(F.col("c_dst").alias("c"), F.lit(0.0).alias("inside"), F.col("w")),
            )
        ).alias("e")
    ).select("e.*")
    per = ends.groupBy("c").agg(F.sum("inside").alias("inside"), F.sum("w").alias("tot"))
    two_m = F.sum("tot")
    return per.agg(
        (F.sum("inside") / two_m - F.lit(resolution) * F.sum(F.col("tot") * F.col("tot")) / (two_m * two_m)).alias(
            "modularity"
        )
    )
