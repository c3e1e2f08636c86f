"""Tables of a data folder, and the inputs derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corvane.functions.text import fold_accents
from corvane.lineage import cut
from corvane.operators import cooccurrence, mentions
from corvane.operators.graph_stats import nodes_of


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread_out(table(spark, folder, "documents"))


def spread_out(df: DataFrame) -> DataFrame:
    """Share the rows of a few files among all cores before costly row-level work.

    Splits of a small file can be empty, as a row group is never cut. A table with several splits
    per core, as any large one has, is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < 2 * cores else df


def folded(c: Column) -> Column:
    return F.lower(fold_accents(F.lower(c)))


def entity_dictionary(spark: SparkSession, folder: str) -> DataFrame:
    """Fifty words by rank of document frequency stand in for a list of names."""
    words = F.regexp_extract_all(folded(F.col("text")), F.lit(r"\p{L}{5,}"), F.lit(0))
    return mentions.frequent_words(documents(spark, folder), "doc_id", words, 301, 350).select(
        F.col("word").alias("alias"), F.col("word").alias("entity")
    )


def document_mentions(spark: SparkSession, folder: str, dictionary: DataFrame | None = None) -> DataFrame:
    """Entities per line; the lines are the paragraphs of these documents. A dictionary already found may be given."""
    lines = mentions.lines_of(documents(spark, folder), "doc_id")
    searchable = lines.select("doc_id", "line_no", folded(F.col("line")).alias("line"))
    if dictionary is None:
        dictionary = entity_dictionary(spark, folder)
    return mentions.match_entities(searchable, "line", dictionary)


def mention_graph(spark: SparkSession, folder: str, dictionary: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Written once: its users read nodes and edges many times, and each time would read all texts again."""
    found = cut(document_mentions(spark, folder, dictionary).select("doc_id", "line_no", "entity"), "mentions")
    edges = cooccurrence.mention_edges(found, ["doc_id", "line_no"])
    return cut(cooccurrence.mention_nodes(found), "nodes"), cut(edges, "edges")


def part_graph(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Parts that were ordered together at least twice; the edges are counted once and written."""
    edges = cut(cooccurrence.cooccurrence_edges(table(spark, folder, "lineitem"), "l_orderkey", "l_partkey", 2), "edges")
    return nodes_of(edges), edges


def part_communities(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("community"))


def persons(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer")


def binary_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors with the two-class label of the experiments."""
    return table(spark, folder, "embeddings").select(
        "vec_id", F.col("embedding").alias("v"), (F.col("label") < 5).cast("int").alias("truth"), "label"
    )


def labelled_documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id")
