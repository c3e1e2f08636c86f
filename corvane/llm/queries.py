"""Registered queries of the operators, one per operator, over the whole of their tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corvane.lineage import fresh_path
from corvane.llm import coder, collocations, decontam, forest, language, negatives, neighbours, packing, pieces, spans, toxicity, urls

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_substring_dedup")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """Words left of each document once passages of 20 words that start earlier are removed."""
    done = spans.substring_dedup(table(spark, folder, "documents").select("doc_id", "text"), 20, join_words=True)
    return done.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text"), 256).alias("kept_sha256"))


@query("op3_suffix_dedup")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """Spans of at least 50 words removed from each document because they start earlier, and what is left."""
    done = spans.suffix_dedup(table(spark, folder, "documents").select("doc_id", "text"), 50, join_words=True)
    return done.select("doc_id", "n_words", "n_removed", "removed_spans", F.sha2(F.col("text"), 256).alias("kept_sha256"))


def bpe_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op2_packing")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 tokens."""
    return packing.pack(table(spark, folder, "documents"), bpe_file(), capacity=1024, end_id=0)


def crc_of_id(c: str) -> Column:
    return F.crc32(F.col(c).cast("string").cast("binary"))


@query("op4_toxicity")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document, learnt from the labels whose crc32 modulo 5 is not 0."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = toxicity.toxicity(docs, table(spark, folder, "labels"), crc_of_id("doc_id") % 5 != 0)
    held_out = F.coalesce(crc_of_id("doc_id") % 5 == 0, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held_out, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op5_near_dedup")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return forest.near_duplicates(table(spark, folder, "documents"), words=5, percent=75)


@query("op8_benchmark_decontamination", decontam.SQL)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold a benchmark item, with the similarity of the best window."""
    found = decontam.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"), percent=75)
    return found.select("doc_id", "item_id", "similarity")


def drawn(c: Column) -> Column:
    """A number below 2**24 that a text fixes."""
    return F.conv(F.substring(F.md5(c), 1, 6), 16, 10).cast("int")


def list_entries(pages: DataFrame) -> DataFrame:
    """A dated list over the hosts and first path parts of the captures: blocks, later removals, and allowances."""
    seen = pages.select(urls.host_of(F.col("url")).alias("host"), urls.part_of(F.col("url")).alias("part")).where("host <> ''")
    day = lambda n: F.date_add(F.lit("2024-01-01").cast("date"), n)
    hosts = seen.select("host").distinct().select(F.col("host").alias("pattern"), drawn(F.col("host")).alias("d"))
    parts = (
        seen.where("part <> ''").select(F.concat("host", F.lit("/"), "part").alias("pattern")).distinct()
        .select("pattern", drawn(F.col("pattern")).alias("d"))
    )
    entry = lambda df, action, on: df.select("pattern", F.lit(action).alias("action"), on.alias("on"))
    d = F.col("d")
    return (
        entry(hosts.where(d % 3 == 0), "block", day(d % 180))
        .unionByName(entry(hosts.where(d % 6 == 0), "remove", day(d % 180 + 90)))
        .unionByName(entry(hosts.where(d % 12 == 0), "block", day(d % 180 + 150)))
        .unionByName(entry(parts.where(d % 5 == 0), "allow", day(d % 200)))
    )


@query("op9_url_filters", """
WITH c AS (
  SELECT page_id, CAST(DATE '2024-01-01' + CAST(page_id % 366 AS INTEGER) AS DATE) AS fetched_on,
         lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1)) AS host,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^/?#]+)', 1) AS part FROM pages),
h AS (SELECT DISTINCT host AS pattern, CAST('0x' || substr(md5(host), 1, 6) AS INTEGER) AS d FROM c WHERE host <> ''),
p AS (SELECT DISTINCT host || '/' || part AS pattern, CAST('0x' || substr(md5(host || '/' || part), 1, 6) AS INTEGER) AS d
      FROM c WHERE host <> '' AND part <> ''),
e AS (
  SELECT pattern, 3 AS n, CAST(DATE '2024-01-01' + d % 180 AS DATE) AS since FROM h WHERE d % 3 = 0
  UNION ALL SELECT pattern, 1, CAST(DATE '2024-01-01' + (d % 180 + 90) AS DATE) FROM h WHERE d % 6 = 0
  UNION ALL SELECT pattern, 3, CAST(DATE '2024-01-01' + (d % 180 + 150) AS DATE) FROM h WHERE d % 12 = 0
  UNION ALL SELECT pattern, 2, CAST(DATE '2024-01-01' + d % 200 AS DATE) FROM p WHERE d % 5 = 0),
latest AS (
  SELECT page_id, e.pattern, arg_max(n, since) AS n, max(since) AS since
  FROM c JOIN e ON (c.host = e.pattern OR c.host LIKE '%.' || e.pattern OR c.host || '/' || c.part = e.pattern) AND since <= fetched_on
  GROUP BY page_id, e.pattern),
best AS (SELECT page_id, arg_max(pattern, length(pattern)) AS pattern, arg_max(n, length(pattern)) AS n,
                arg_max(since, length(pattern)) AS since FROM latest WHERE n > 1 GROUP BY page_id)
SELECT page_id, host, fetched_on, CASE n WHEN 3 THEN 'block' WHEN 2 THEN 'allow' ELSE 'none' END AS verdict,
       pattern, since AS listed_on FROM c LEFT JOIN best USING (page_id)
""")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    """Every capture judged by the entries active on the day it was fetched."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    on = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 366).cast("int"))
    found = urls.verdicts(pages.select(F.col("page_id").alias("capture_id"), "url", on.alias("on")), list_entries(pages))
    return found.select(F.col("capture_id").alias("page_id"), "host", F.col("on").alias("fetched_on"), "verdict", "pattern", "listed_on")


@query("op10_token_ids")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of all documents written to files of coded blocks, and what reading them back gives."""
    path = fresh_path(spark, "token-ids")
    coder.write_ids(table(spark, folder, "documents"), bpe_file(), path, end_id=2)
    return coder.read_ids(spark, path)


@query("op6_nearest_vectors")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest vectors of every fiftieth one."""
    return neighbours.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query("op7_language_id")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learnt from those whose crc32 modulo 4 is not 2."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    found = language.detect(docs, bpe_file(), crc_of_id("doc_id") % 4 != 2)
    held_out = F.coalesce(crc_of_id("doc_id") % 4 == 2, F.lit(False)).alias("held_out")
    return found.select("doc_id", held_out, "lang_pred", "score")


def piece_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query("op12_sentencepiece")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """Number and digest of every document's ids, and digest of the text decoded from them."""
    return pieces.encode_decode(table(spark, folder, "documents"), piece_file(), digests=True)


@query("op13_hard_negatives", negatives.SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """Three hard negatives for each of the five positives of every fiftieth vector."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, label=label)


@query("op11_collocations", collocations.SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """The first 2000 collocations of every language."""
    return collocations.collocations(table(spark, folder, "documents"))
