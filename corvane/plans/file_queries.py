"""Round trips through files in the shared folder, and row-level steps."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from corvane.functions import person, vectors as vec
from corvane.lineage import cut, fresh_path
from corvane.operators import features, vectors
from corvane.operators.neighbours import vector_widths
from corvane.plans.registry import query
from corvane.plans.tables import persons, table
from corvane.functions.text import split_words
from corvane.sources import files


@query("csv_roundtrip", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_roundtrip(spark, folder):
    rows = persons(spark, folder)
    path = fresh_path(spark, "csv")
    files.write_csv(rows, path)
    return files.read_csv(spark, path, rows.schema)


@query("csv_by_name", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def csv_by_name(spark, folder):
    """Some columns of a file whose columns stand in another order."""
    rows = persons(spark, folder)
    path = fresh_path(spark, "csv")
    files.write_csv(rows.select(*reversed(rows.columns)), path)
    return files.read_csv(spark, path, rows.select("c_custkey", "c_name", "c_acctbal").schema)


@query("csv_multiline", "SELECT doc_id, nullif(text, '') AS text FROM documents")
def csv_multiline(spark, folder):
    """Whole texts with their line breaks, through a file."""
    rows = table(spark, folder, "documents").select("doc_id", "text")
    path = fresh_path(spark, "csv")
    files.write_csv(rows, path)
    return files.read_csv(spark, path, rows.schema, multi_line=True)


@query(
    "indexed_csv",
    "SELECT c_custkey AS index, c_name AS body, 1 AS subreddit FROM customer",
)
def indexed_csv(spark, folder):
    """A CSV whose first column has no name, read back with the column named and a label added."""
    rows = persons(spark, folder).select(F.col("c_custkey").alias("_c0"), F.col("c_name").alias("body"))
    path = fresh_path(spark, "csv")
    files.write_csv(rows, path)
    named = files.without_index(files.read_csv(spark, path, rows.schema))
    return features.with_label(named, "subreddit", 1)


@query(
    "vectors_roundtrip",
    """SELECT vec_id AS row_id, label, CASE WHEN label < 5 THEN 'train' ELSE 'test' END AS split,
              round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 6) AS total
       FROM embeddings""",
)
def vectors_roundtrip(spark, folder):
    rows = table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("row_id"),
        F.col("embedding").alias("v"),
        "label",
        F.when(F.col("label") < 5, "train").otherwise("test").alias("split"),
    )
    path = fresh_path(spark, "vectors")
    files.write_vectors(rows, path)
    total = F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x)
    return files.read_vectors(spark, path).select("row_id", "label", "split", F.round(total, 6).alias("total"))


@query("model_roundtrip")
def model_roundtrip(spark, folder):
    """Word vectors saved, loaded and used on the documents again."""
    tokens = cut(table(spark, folder, "documents").select("doc_id", split_words(F.lower("text")).alias("tokens")), "tokens")
    parts = vectors.training_parts(table(spark, folder, "documents"))
    model = vectors.fit_word_vectors(
        tokens, "tokens", size=16, window=5, min_count=5, step=0.025, epochs=1, partitions=parts, keys=["doc_id"], stored=True
    )
    path = fresh_path(spark, "model")
    files.save_model(model, path)
    loaded = files.load_word_model(path)
    return vectors.document_vectors(loaded, tokens, ["doc_id"]).select("doc_id", F.size("vector").alias("width"))


@query("text_lines", "SELECT unnest(string_split(text, chr(10))) AS text FROM documents")
def text_lines(spark, folder):
    path = fresh_path(spark, "text")
    files.write_lines(table(spark, folder, "documents"), "text", path)
    return files.read_lines(spark, path)


@query(
    "whole_text",
    """SELECT lang, CAST(sum(length(text) + 1) AS BIGINT) AS n_chars,
              CAST(sum(len(string_split(text, chr(10)))) AS BIGINT) AS n_lines
       FROM documents GROUP BY lang""",
)
def whole_text(spark, folder):
    """Files read in one piece each, one folder per language."""
    path = fresh_path(spark, "text")
    files.write_lines(table(spark, folder, "documents"), "text", path, partition_by="lang")
    whole = files.read_whole(spark, path)
    return whole.groupBy(F.regexp_extract("file", "lang=([^/]+)", 1).alias("lang")).agg(
        F.sum(F.length("text")).cast("bigint").alias("n_chars"),
        F.sum(F.size(F.split("text", "\n")) - 1).cast("bigint").alias("n_lines"),
    )


@query(
    "file_paragraphs",
    """SELECT text, count(*) AS n
       FROM (SELECT unnest(string_split(replace(text, chr(10), chr(10) || chr(10)), chr(10) || chr(10))) AS text
             FROM documents)
       WHERE text <> '' GROUP BY text""",
)
def file_paragraphs(spark, folder):
    """Paragraphs of text files whose paragraphs are parted by an empty line."""
    spaced = F.concat(F.regexp_replace("text", "\n", "\n\n"), F.lit("\n")).alias("text")
    path = fresh_path(spark, "text")
    files.write_lines(table(spark, folder, "documents").select(spaced), "text", path)
    return files.read_paragraphs(spark, path).groupBy("text").agg(F.count("*").alias("n"))


@query("head_rows", "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 5")
def head_rows(spark, folder):
    return files.head(persons(spark, folder).select("c_custkey", "c_name"), "c_custkey")


@query(
    "prune_and_label",
    """SELECT doc_id, quality, 0 AS subreddit FROM labels WHERE toxic = 0
       UNION ALL SELECT doc_id, quality, 1 AS subreddit FROM labels WHERE toxic = 1""",
)
def prune_and_label(spark, folder):
    """Two tables of one schema, each with its constant label, in one."""
    labels = table(spark, folder, "labels")
    side = lambda v: features.with_label(labels.filter(F.col("toxic") == v).drop("toxic"), "subreddit", v)
    return side(0).unionByName(side(1))


@query("filter_class", "SELECT doc_id, quality, toxic FROM labels WHERE quality = 1 AND toxic = 0")
def filter_class(spark, folder):
    return table(spark, folder, "labels").filter((F.col("quality") == 1) & (F.col("toxic") == 0))


@query("invert_labels", "SELECT doc_id, 1 - quality AS inverted FROM labels")
def invert_labels(spark, folder):
    return table(spark, folder, "labels").select("doc_id", person.inverted(F.col("quality")).alias("inverted"))


@query(
    "threshold_scores",
    "SELECT l_orderkey, l_linenumber, CAST(l_discount * 10 >= 0.5 AS INTEGER) AS flag FROM lineitem",
)
def threshold_scores(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", person.thresholded(F.col("l_discount") * 10).alias("flag")
    )


@query(
    "recode_binary",
    "SELECT c_custkey, CASE WHEN c_mktsegment = 'MACHINERY' THEN 0 ELSE 1 END AS diagnosis FROM customer",
)
def recode_binary(spark, folder):
    return persons(spark, folder).select(
        "c_custkey", person.recode_binary(F.col("c_mktsegment"), "MACHINERY").alias("diagnosis")
    )


@query(
    "scalar_functions",
    """SELECT c_custkey, sha1(c_name) AS digest, CAST(floor(c_acctbal / 7.0) AS BIGINT) AS floored,
              round(ln(abs(c_acctbal) + 1), 6) AS logarithm, round(sqrt(abs(c_acctbal)), 6) AS root,
              CAST(ceil(c_acctbal / 100.0) AS BIGINT) AS up, round(c_acctbal / 3.0, 2) AS rounded
       FROM customer""",
)
def scalar_functions(spark, folder):
    b = F.col("c_acctbal")
    return persons(spark, folder).select(
        "c_custkey",
        F.sha1("c_name").alias("digest"),
        F.floor(b / 7.0).cast("bigint").alias("floored"),
        F.round(F.ln(F.abs(b) + 1), 6).alias("logarithm"),
        F.round(F.sqrt(F.abs(b)), 6).alias("root"),
        F.ceil(b / 100.0).cast("bigint").alias("up"),
        F.round(b / 3.0, 2).alias("rounded"),
    )


@query(
    "flatten_vectors",
    """SELECT vec_id, 2 * len(embedding) AS width, round(CAST(embedding[1] AS DOUBLE), 6) AS first_value,
              round(CAST(embedding[len(embedding)] AS DOUBLE), 6) AS last_value
       FROM embeddings""",
)
def flatten_vectors(spark, folder):
    """A matrix per row (here the vector and its mirror image) laid out as one vector."""
    matrix = F.array(F.col("embedding"), F.reverse("embedding"))
    rows = table(spark, folder, "embeddings").select("vec_id", vec.flattened(matrix).alias("v"), "embedding")
    n = F.size("embedding")
    return rows.select(
        "vec_id",
        vec.width(F.col("v")).cast("bigint").alias("width"),
        F.round(F.get("v", n * 2 - 1).cast("double"), 6).alias("first_value"),
        F.round(F.get("v", n - 1).cast("double"), 6).alias("last_value"),
    )


@query(
    "feature_matrix",
    """SELECT l_orderkey, l_linenumber, round(l_quantity + l_extendedprice + l_discount + l_tax, 4) AS total, 4 AS width
       FROM lineitem""",
)
def feature_matrix(spark, folder):
    """All columns but the keys as one feature vector."""
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"
    )
    columns = features.feature_columns(rows, "l_orderkey", "l_linenumber")
    v = vector_to_array("features")
    return features.assemble(rows, columns).select(
        "l_orderkey",
        "l_linenumber",
        F.round(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x), 4).alias("total"),
        F.size(v).alias("width"),
    )


@query("vector_width", "SELECT len(embedding) AS width, count(*) AS n FROM embeddings GROUP BY 1")
def vector_width(spark, folder):
    return vector_widths(table(spark, folder, "embeddings"), "embedding").withColumn("width", F.col("width").cast("bigint"))


@query(
    "keyed_concat",
    """SELECT d.doc_id, d.lang, d.n_chars, l.quality, l.toxic
       FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
)
def keyed_concat(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    return features.concat_keyed(documents, table(spark, folder, "labels"), "doc_id")


