"""The corpus pipeline: five stages from raw documents to packed training sequences.

Each stage works on all that its predecessor kept.  The stages are expressed by operators without an SQL form
(learnt scores, tokenizers), so the pipeline has none; ``tests/llm`` holds it against a plain version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corvane.lineage import cut
from corvane.llm import decontam, forest, packing, queries, spans, toxicity


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator scores below one half."""
    labels = queries.table(spark, sf_dir, "labels")
    return toxicity.keep_clean(docs, labels, queries.crc_of_id("doc_id") % 5 != 0)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates."""
    return forest.keep_one(docs)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages of 50 words that start earlier somewhere else."""
    cleaned = spans.suffix_dedup(docs, 50)
    n_chars = F.when(F.col("n_removed") > 0, F.char_length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return cleaned.withColumn("n_chars", n_chars).select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontam.keep_uncontaminated(docs, queries.table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1024 tokens."""
    return packing.pack(docs, queries.bpe_file(), capacity=1024, end_id=0)


STAGES = [
    ("toxicity", without_toxic),
    ("minhash_near_dedup", without_near_duplicates),
    ("suffix_array_dedup", without_repeated_passages),
    ("benchmark_decontamination", without_benchmark),
    ("packing", packed),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
