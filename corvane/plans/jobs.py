"""The end-to-end jobs, from files to results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from corvane.functions import person, text as t
from corvane.functions.stem import stem_text
from corvane.lineage import cut
from corvane.operators import (
    classifiers,
    clusters,
    communities,
    cooccurrence,
    experiments,
    features,
    influence,
    mentions,
    release as r,
    vectors,
)
from corvane.sources import files

PERSONS = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in ("id", "dob", "zipcode", "gender", "education", "employment", "marital_status", "ancestry", "accommodation")
    ]
    + [T.StructField(name, T.IntegerType()) for name in ("children", "number_vehicles")]
    + [T.StructField("commute_time", T.DoubleType()), T.StructField("disease", T.StringType())]
)
CODED = ["gender", "education", "employment", "marital_status", "ancestry", "accommodation"]
COMMENTS = T.StructType(
    [T.StructField("_c0", T.LongType()), T.StructField("body", T.StringType())]
)


def book_graph(
    spark: SparkSession, path: str, dictionary: DataFrame, match: str = "substring"
) -> tuple[DataFrame, DataFrame]:
    """Entities of a text file, linked when a paragraph names both."""
    # the numbers only tell paragraphs apart; writing the table fixes them
    numbered = cut(
        files.read_paragraphs(spark, path).select(F.monotonically_increasing_id().alias("para_id"), "text"), "paragraphs"
    )
    folded = numbered.select("para_id", F.lower(t.fold_accents(F.lower(F.regexp_replace("text", "\n", " ")))).alias("line"))
    found = cut(mentions.match_entities(folded, "line", dictionary, match), "mentions")
    return cooccurrence.mention_nodes(found), cooccurrence.mention_edges(found, ["para_id"])


def influence_report(
    nodes: DataFrame, edges: DataFrame, share: float, p: float, runs: int, population: int, seed: int = 1
) -> tuple[DataFrame, DataFrame]:
    """Random, highest-degree and greedy seeds compared: (mean curve, final sizes)."""
    n = influence.seed_count(share, population)
    named = lambda df, name: df.select(F.lit(name).alias("strategy"), "id")
    seeds = (
        named(influence.random_seeds(nodes, n, seed), "random")
        .unionByName(named(influence.top_degree_seeds(nodes, edges, n), "degree"))
        .unionByName(named(influence.greedy_frontier_seeds(nodes, edges, n), "greedy"))
    )
    reached = influence.cascades(edges, seeds, p, runs, seed)
    return influence.mean_curve(influence.cascade_series(reached)), influence.strategy_stats(reached)


def book_embedding(spark: SparkSession, path: str, dictionary: DataFrame, **training) -> DataFrame:
    """Agreement of graph communities and of clusters of word vectors, for the entities of a text file."""
    nodes, edges = book_graph(spark, path, dictionary)
    partition = communities.final_partition(communities.louvain(nodes, edges))
    names = [x.entity for x in dictionary.select("entity").distinct().collect()]
    whole = files.read_paragraphs(spark, path).select(F.regexp_replace("text", "\n", " ").alias("text"))
    sentences = whole.select(F.explode(t.sentences(F.col("text"))).alias("s"))
    clean = t.join_compounds(F.lower(t.fold_accents_drop_commas(F.col("s"))), names)
    tokens = sentences.select(t.apply_filters(clean, t.vector_filters(4)).alias("tokens"))
    words = vectors.vocabulary(vectors.fit_word_vectors(tokens, "tokens", **training))
    entities = nodes.select(F.translate("id", " ", "_").alias("word"))
    found = vectors.entity_vectors(entities, words).select(F.translate("word", "_", " ").alias("word"), "v")
    return experiments.embedding_vs_community(found, partition)


def release_by_birth_and_place(persons: DataFrame, salts: tuple[str, str], k: int = 10, l: int = 5, t_max: float = 0.5):
    """Year and zipcode ranges identify a class; returns (released rows, entropy loss)."""
    qi = ["dob", "zipcode"]
    rows = persons.select(
        person.pseudonym(F.col("id"), *salts).alias("id"),
        person.floor_bucket(person.date_part(F.col("dob")), 25).alias("dob"),
        person.floor_bucket(F.col("zipcode").cast("int"), 2000).alias("zipcode"),
        "disease",
    )
    kept = cut(r.release(rows, qi, "disease", k, l, t_max, r.distribution(rows, "disease")), "released")
    return kept, r.entropy_loss(persons, kept, qi)


def release_by_household(persons: DataFrame, salts: tuple[str, str], k: int = 6, l: int = 4, t_max: float = 0.2):
    """Five household columns identify a class; every disease present in a class counts once."""
    qi = ["employment", "children", "marital_status", "commute_time", "education"]
    merged = persons.withColumn("disease", person.merge_on_token(F.col("disease"), "cancer"))
    coded = r.label_encode(merged, CODED)
    rows = coded.withColumns(
        {
            "id": person.pseudonym(F.col("id"), *salts),
            "education": person.override_unless(F.col("employment") == 2, F.col("education"), 5),
        }
    ).drop("gender", "dob", "zipcode", "ancestry", "number_vehicles", "accommodation")
    kept = cut(r.release(rows, qi, "disease", k, l, t_max, r.distribution(rows, "disease"), "presence"), "released")
    return kept, r.entropy_loss(persons, kept, qi)


def read_comments(spark: SparkSession, paths: dict[tuple[str, int], str]) -> DataFrame:
    """CSV files by (split, label) in one table with a key: (key, body, subreddit, split)."""
    parts = []
    for (split, label), path in paths.items():
        rows = files.without_index(files.read_csv(spark, path, COMMENTS, multi_line=True))
        key = F.concat_ws("/", F.lit(split), F.lit(label), "index")
        parts.append(features.with_label(rows, "subreddit", label).select(key.alias("key"), "body", "subreddit", F.lit(split).alias("split")))
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    return table


def classify_comments(
    comments: DataFrame, stop_words: Sequence[str], models: dict, size: int = 300, window: int = 4, min_count: int = 4,
    epochs: int = 20, k: int = 10,
) -> DataFrame:
    """Document vectors of all comments, scaled by the training rows, and the accuracy of every model."""
    chain = t.classification_filters(stop_words, stem_text)
    tokens = cut(comments.withColumn("tokens", t.apply_filters(F.col("body"), chain)).drop("body"), "tokens")
    model = vectors.fit_word_vectors(tokens, "tokens", size, window, min_count, 0.01, epochs)
    embedded = vectors.document_vectors(model, tokens).select(
        "key", "split", F.col("subreddit").cast("double").alias("label"), F.col("vector").alias("v")
    )
    wide = cut(clusters.with_features(embedded, "v"), "vectors")
    scaler = features.fit_minmax(features.only_split(wide, "train"))
    scaled = features.clipped(scaler.transform(wide).drop("features").withColumnRenamed("scaled", "features"), "features")
    table = cut(scaled.drop("v").withColumn("v", features.vector_to_array("features")), "scaled")
    train, test = features.only_split(table, "train"), features.only_split(table, "test")
    found = classifiers.compare_models(train, test, models)
    votes = classifiers.knn_classify(train, table, "key", "v", "label", k)
    hit = F.avg((F.col("label") == F.col("predicted")).cast("double")).alias("accuracy")
    near = votes.join(table.select("key", "split", "label"), "key").groupBy("split").agg(hit)
    return found.unionByName(near.select(F.lit("neighbours").alias("model"), "split", "accuracy"))


def read_measurements(spark: SparkSession, path: str, columns: Sequence[str], scale: bool = True) -> DataFrame:
    """(id, v, truth) of a table with a diagnosis and numeric columns; other columns play no part."""
    schema = T.StructType(
        [T.StructField("id", T.LongType()), T.StructField("diagnosis", T.StringType())]
        + [T.StructField(c, T.DoubleType()) for c in columns]
    )
    rows = files.read_csv(spark, path, schema)
    if scale:
        rows = features.scaled_columns(rows, columns)
    return rows.select(
        "id", F.array(*columns).alias("v"), person.recode_binary(F.col("diagnosis"), "M").alias("truth")
    )
