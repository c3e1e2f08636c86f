"""Benchmark items found again in documents, by DataFrame functions alone.

Words are lower-cased (A to Z) runs between white space.  A document holds an item if some window of as many words
as the item has is similar enough: the weighted Jaccard similarity of their five-word shingles, each weighted by how
often it stands there.  An item of fewer words than a shingle is one shingle.  A document of fewer words than an item
is one window as a whole.

1. Positions whose shingle stands in some item are found by a join of hashes.  A window that is similar enough
   holds at least a known number of such positions, and moving its start to the next one, or to the last possible
   start, loses none, so only these starts are looked at.
2. Distinct windows and items get 64-bit SimHash fingerprints.  Sixteen four-bit blocks form a multi-index: two
   fingerprints within the radius of 28 bits agree in some block up to one bit, so a join on blocks finds them all.
   A pair at the threshold of 0.75 differs in 11 bits on average with a deviation of 3.
3. Exact similarity of the shingle counts decides.

Defined cases: a null or empty text holds nothing; a null or empty item is ignored, and items that repeat an id are
judged one by one and reported once, by the best; a document without a whole shingle holds nothing; documents that repeat an
id are judged one by one and reported once, by the best window; rows without an id are judged too; other columns
play no part; empty tables give an empty table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from corvane.lineage import cut

SHINGLE = 5
RADIUS = 28
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), r"[\x20\x09-\x0D]+"), "")


def shingles_of(words: Column, k: int) -> Column:
    """Hashes of the k words from each position on.

    The words are bound to a lambda variable, and the result leaves a generator, so that neither is computed again
    wherever it is named.
    """
    def hashes(w: Column) -> Column:
        each = F.transform(w, lambda x, i: F.xxhash64(x, *[F.get(w, i + d) for d in range(1, k)]))
        return F.slice(each, 1, F.greatest(F.size(w) - (k - 1), F.lit(0)))

    return F.explode(F.transform(F.array(words), hashes))


def _fingerprint(exploded: DataFrame, keys: list[str], hash_col: str, total: str) -> DataFrame:
    """SimHash of the hashes of each group; four 16-bit counters to a sum."""
    h = F.col(hash_col)

    def spread(j: int) -> Column:
        x = F.shiftrightunsigned(h, 4 * j).bitwiseAND(F.lit(15).cast("long"))
        lanes = [F.shiftleft(x.bitwiseAND(F.lit(1 << i).cast("long")), 15 * i) for i in range(4)]
        return reduce(Column.bitwiseOR, lanes)

    sums = exploded.groupBy(*keys).agg(F.first(total).alias("__total"), *[F.sum(spread(j)).alias(f"__s{j}") for j in range(16)])

    def bit(j: int, i: int) -> Column:
        count = F.shiftrightunsigned(F.col(f"__s{j}"), 16 * i).bitwiseAND(F.lit(65535).cast("long"))
        return F.shiftleft((2 * count > F.col("__total")).cast("long"), 4 * j + i)

    bits = [bit(j, i) for j in range(16) for i in range(4)]
    return sums.select(*keys, reduce(Column.bitwiseOR, bits).alias("fingerprint"))


def _block(fingerprint: Column, j: Column) -> Column:
    return F.expr("cast(shiftrightunsigned(fingerprint, cast(4 * j as int)) & 15 as int)")


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = 75,
    most_broadcast: int = 500_000,
) -> DataFrame:
    """(doc_id, item_id, similarity, start): the best window of each item that a document holds, by its first word.

    Item shingles and ids of documents with candidates are broadcast up to ``most_broadcast`` rows and joined by a
    shuffle beyond; the result is the same.
    """
    small = lambda df: F.broadcast(df) if df.count() <= most_broadcast else df
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(id_col).cast("long"), text_col).alias("key"),
        F.col(text_col).alias("text"),
    ).where("text is not null")
    sized = items.select("item_id", words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    sized = cut(
        sized.select("*", F.xxhash64("words").alias("item"), F.size("words").alias("n"), F.least(F.size("words"), F.lit(SHINGLE)).alias("k")),
        "items",
    )
    found = [_contaminated(texts, sized.where(F.col("k") == k), k, percent, small) for (k,) in sized.select("k").distinct().orderBy("k").collect()]
    if not found:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, similarity double, start long")
    every = reduce(DataFrame.unionByName, found)
    best = F.max_by(F.struct("similarity", "start"), F.struct("similarity", -F.col("start")))
    return every.groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", "b.similarity", "b.start")


def _contaminated(texts: DataFrame, items: DataFrame, k: int, percent: int, small) -> DataFrame:
    # an item has w = n - k + 1 shingles and a window m, as many or all of a shorter document:
    # shared >= percent / (100 + percent) of both together
    total = F.col("n") - (k - 1)
    one = items.select("item", "n", "words").distinct()
    of_item = cut(
        one.select("item", "n", total.alias("w"), shingles_of(F.col("words"), k).alias("hashes"))
        .select("item", "n", "w", F.explode("hashes").alias("h")).groupBy("item", "n", "w", "h").agg(F.count(F.lit(1)).alias("times")),
        "item-shingles",
    )
    shingled = texts.select("doc_id", "key", shingles_of(words_of(F.col("text")), k).alias("hashes"))
    places = shingled.select("key", F.size("hashes").alias("last"), F.posexplode("hashes").alias("pos", "h"))
    hits = places.join(small(of_item.select("h").distinct()), "h", "left_semi").distinct()
    need = F.ceil((F.col("w") + F.col("m")) * percent / F.lit(100 + percent))
    dense = (
        cut(hits, "hits").join(small(of_item.select("h", "item", "n", "w")), "h").withColumn("m", F.least("w", "last"))
        .groupBy("key", "item", "n", "w", "m", "last").agg(F.collect_list("pos").alias("at"))
        .where(F.size("at") >= need)
    )
    starts = cut(
        dense.select("key", "n", "w", "m", F.explode(F.array_distinct(F.expr("transform(at, p -> least(p, last - m))"))).alias("start")).distinct(),
        "starts",
    )
    chosen = cut(shingled.join(small(starts.select("key").distinct()), "key", "left_semi").dropDuplicates(["doc_id", "key"]), "chosen")
    windows = cut(
        starts.join(chosen, "key")
        .select("doc_id", "n", "w", "m", "start", F.expr("slice(hashes, start + 1, m)").alias("hashes"))
        .withColumn("window", F.xxhash64("hashes")),
        "windows",
    )
    shapes = windows.groupBy("n", "w", "m", "window").agg(F.first("hashes").alias("hashes"))
    exploded = cut(shapes.select("n", "w", "m", "window", F.explode("hashes").alias("h")), "shapes")
    marks = _fingerprint(exploded, ["n", "window"], "h", "m")
    item_marks = _fingerprint(
        of_item.select("item", "n", "w", F.explode(F.array_repeat("h", F.col("times").cast("int"))).alias("h")), ["item", "n"], "h", "w"
    )
    blocks = F.explode(F.sequence(F.lit(0), F.lit(15))).alias("j")
    flips = F.explode(F.array(*[F.lit(x) for x in (0, 1, 2, 4, 8)])).alias("flip")
    left = marks.select("*", blocks).select("n", "window", "fingerprint", "j", _block(F.col("fingerprint"), F.col("j")).alias("value"))
    right = (
        item_marks.select("*", blocks).select("*", flips)
        .select("n", "item", F.col("fingerprint").alias("mark"), "j", _block(F.col("fingerprint"), F.col("j")).bitwiseXOR(F.col("flip")).alias("value"))
    )
    near = F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("mark"))) <= RADIUS
    candidates = left.join(right, ["n", "j", "value"]).where(near).select("n", "window", "item").distinct()
    union = F.col("w") + F.col("m") - F.col("shared")
    counted = exploded.groupBy("n", "w", "m", "window", "h").agg(F.count(F.lit(1)).alias("here"))
    shared = (
        counted.join(of_item.select("item", "n", "h", "times"), ["n", "h"]).join(candidates, ["n", "window", "item"], "left_semi")
        .groupBy("n", "w", "m", "window", "item").agg(F.sum(F.least("here", "times")).alias("shared"))
        .where(F.col("shared") * 100 >= percent * union)
    )
    similar = shared.select("n", "window", "item", (F.col("shared") / union).alias("similarity"))
    named = similar.join(items.select("item", "item_id"), "item")
    return windows.select("doc_id", "n", "window", "start").join(named, ["n", "window"]).select(
        "doc_id", "item_id", "similarity", F.col("start").cast("long").alias("start")
    )


def keep_uncontaminated(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", most_broadcast: int = 500_000, **options) -> DataFrame:
    """The rows of ``docs`` that hold no item, unchanged; ids that repeat go together, rows without an id stay."""
    found = contaminated(docs, items, id_col=id_col, most_broadcast=most_broadcast, **options)
    gone = cut(found.select("doc_id").where("doc_id is not null").distinct(), "gone")
    side = F.broadcast(gone) if gone.count() <= most_broadcast else gone
    return docs.join(side, docs[id_col] == gone["doc_id"], "left_anti")


SQL = """
WITH dw AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL),
iw AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w, least(len(w), 5) AS k FROM benchmark WHERE text IS NOT NULL),
ds AS (SELECT doc_id, k, p - 1 AS p, len(w) - k + 1 AS last, array_to_string(w[p:p + k - 1], ' ') AS s
       FROM dw, (SELECT DISTINCT k FROM iw WHERE k > 0) ks, range(1, len(w) - k + 2) t(p)),
its AS (SELECT item_id, k, len(w) - k + 1 AS n, array_to_string(w[p:p + k - 1], ' ') AS s, count(*) AS times
        FROM iw, range(1, len(w) - k + 2) t(p) WHERE k > 0 GROUP BY ALL),
hits AS (SELECT DISTINCT doc_id, item_id, k, n, least(n, last) AS m, last, p FROM ds JOIN its USING (k, s)),
starts AS (SELECT DISTINCT doc_id, item_id, k, n, m, b AS start
           FROM hits, range(greatest(p - n + 1, 0), least(p, last - m) + 1) t(b)),
shared AS (
  SELECT doc_id, item_id, n, m, start, sum(least(here, times)) AS c
  FROM (SELECT doc_id, item_id, k, n, m, start, s, count(*) AS here
        FROM starts JOIN ds USING (doc_id, k) WHERE ds.p BETWEEN start AND start + m - 1 GROUP BY ALL) x
  JOIN its USING (item_id, k, n, s) GROUP BY ALL)
SELECT doc_id, item_id, max(c / (n + m - c)) AS similarity FROM shared
WHERE c * 100 >= 75 * (n + m - c) GROUP BY ALL
"""
