"""Phrase collocations from count streams in prefix and suffix order.

Texts are lower-cased (A to Z), split into pieces at punctuation and line ends, and pieces into words.  Phrases of one
to three words are counted per language: a task sorts the word codes of a bounded run of text and adds them up, Spark
sums the runs.  Pairs are counted before triples; a triple is looked at only where a bitmap of fixed size holds both of
its pairs, which leaves out no triple that reaches ``least`` (each of its pairs reaches it too) and may let others
through, which the exact counts then drop.  Texts are read twice.

The counts that reach ``least`` are laid out as one stream in prefix order (word by word from the left): a phrase stands
right behind the phrases it begins with, so one pass that keeps the last word and the last pair hands every phrase the
counts of its beginnings.  The stream in suffix order (from the right) does the same for the endings.  A stream is cut
into slices by range; what stands open where a slice begins (a word and a pair) is put at its head once more, so slices are
independent and a word with very many phrases spreads over as many slices as it needs.  Nothing is looked up by hash.

Defined cases: a null text is empty, a null language is `und`; rows with the same or a null id count like any other;
empty pieces and texts hold no phrase; a text of any length is read whole; an empty table gives an empty table; other
columns play no part.  Words are told apart inside a run by 64-bit hashes, across runs by their text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from corvane.lineage import cut
from corvane.llm.wordhash import LOWER, mix, text_slices, word_bounds, word_hashes

BREAK = np.zeros(256, dtype=bool)
BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
GAP = BREAK.copy()
GAP[[0x20, 0x09]] = True
RUN_WORDS = 600_000  # added up before rows leave a task
COUNTS = "lang string, phrase string, f long"
PAIR_BITS = 1 << 26  # of the bitmap of frequent pairs: 8 MB whatever the data
SLICE_ROWS = 200_000
SPACE = pa.scalar(" ", pa.large_string())


class Run:
    """Words of several texts: their codes (one per distinct word of a language), and where phrases end."""

    def __init__(self) -> None:
        self._slot: dict[tuple[int, int], int] = {}
        self._parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self._words: list[pa.Array] = []
        self._hashes: list[np.ndarray] = []
        self.langs: list[str] = []
        self.size = 0

    def add(self, langs: list[str], data: np.ndarray, offsets: np.ndarray) -> None:
        data = LOWER[data]
        starts, ends, first_word = word_bounds(data, offsets, GAP)
        if not len(starts):
            return
        breaks = np.concatenate([[0], np.cumsum(BREAK[data])])
        follows = np.zeros(len(starts), dtype=bool)  # whether the word before is in the same piece
        follows[1:] = breaks[starts[1:]] == breaks[ends[:-1]]
        follows[first_word[:-1][first_word[:-1] < len(starts)]] = False
        known = {lang: i for i, lang in enumerate(self.langs)}
        for lang in dict.fromkeys(langs):
            if lang not in known:
                known[lang] = len(self.langs)
                self.langs.append(lang)
        lang = np.repeat(np.array([known[x] for x in langs], dtype=np.int64), np.diff(first_word))
        hashes = word_hashes(data, starts, ends)
        self._parts.append((hashes, lang, follows))
        # the text of each distinct word of this part; runs are bounded, so are these
        _, at = np.unique(hashes, return_index=True)
        lengths = (ends - starts)[at]
        edges = np.concatenate([[0], np.cumsum(lengths)])
        spelt = data[np.arange(edges[-1]) + np.repeat(starts[at] - edges[:-1], lengths)]
        self._words.append(pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(spelt)))
        self._hashes.append(hashes[at])
        self.size += len(starts)

    def columns(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array, np.ndarray, np.ndarray]:
        """Word codes, whether each follows the word before, and per code: text, language, 64 bits that fix both."""
        hashes, lang, follows = (np.concatenate(x) for x in zip(*self._parts, strict=True))
        keys, first = np.unique(np.concatenate(self._hashes), return_index=True)
        texts = pa.concat_arrays(self._words).take(pa.array(first))
        word = np.searchsorted(keys, hashes)
        pairs, codes = np.unique(word * len(self.langs) + lang, return_inverse=True)
        word, lang = pairs // len(self.langs), pairs % len(self.langs)
        salt = word_salts(self.langs)
        return codes, follows, texts.take(pa.array(word)), lang, mix(keys[word] ^ salt[lang])


def word_salts(langs: list[str]) -> np.ndarray:
    """64 bits a language, the same in every task."""
    marked = [f"#{lang}".encode() for lang in langs]  # an empty one has no bytes of its own
    data = np.frombuffer(b"".join(marked), dtype=np.uint8)
    edges = np.concatenate([[0], np.cumsum([len(x) for x in marked])]).astype(np.int64)
    return mix(word_hashes(data, edges[:-1], edges[1:]), 0x3C6EF372)


def pair_bits(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The place of a pair of words in the bitmap."""
    return (mix(left * np.uint64(0x9E3779B97F4A7C15) + right) % np.uint64(PAIR_BITS)).astype(np.int64)


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[Run]:
    """Runs of about RUN_WORDS words; the columns are lang and text."""
    run = Run()
    for batch in batches:
        langs = batch.column(0).to_pylist()
        for first, last, data, offsets in text_slices(batch.column(1), 1 << 20):
            run.add(langs[first:last], data, offsets)
            if run.size >= RUN_WORDS:
                yield run
                run = Run()
    if run.size:
        yield run


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, dtype=np.int64)
    return keys[at], np.diff(np.append(at, len(keys)))


def rows_of(langs: list[str], lang: np.ndarray, phrase: pa.Array, f: np.ndarray) -> Iterator[pa.RecordBatch]:
    names = pa.array(langs, pa.string()).take(pa.array(lang, pa.int64()))
    for first in range(0, len(f), 100_000):
        part = [names.slice(first, 100_000), phrase.slice(first, 100_000).cast(pa.string()), pa.array(f[first : first + 100_000], pa.int64())]
        yield pa.RecordBatch.from_arrays(part, names=["lang", "phrase", "f"])


def words_and_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words and pairs of words, and under a null phrase of all words."""
    for run in runs(batches):
        codes, follows, texts, lang, _ = run.columns()
        f = np.bincount(codes, minlength=len(texts))
        yield from rows_of(run.langs, lang, texts, f)
        n = np.bincount(lang, weights=f, minlength=len(run.langs)).astype(np.int64)
        yield from rows_of(run.langs, np.arange(len(run.langs)), pa.nulls(len(run.langs), pa.large_string()), n)
        at = np.flatnonzero(follows)
        keys, f = counted(codes[at - 1] * len(texts) + codes[at])
        a, b = keys // len(texts), keys % len(texts)
        for first in range(0, len(f), 200_000):
            part = slice(first, first + 200_000)
            phrase = pc.binary_join_element_wise(texts.take(pa.array(a[part])), texts.take(pa.array(b[part])), SPACE)
            yield from rows_of(run.langs, lang[a[part]], phrase, f[part])


def triples(batches: Iterator[pa.RecordBatch], bitmap: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Counts of triples whose two pairs stand in the bitmap."""
    for run in runs(batches):
        codes, follows, texts, lang, bits = run.columns()
        pair = np.zeros(len(codes), dtype=bool)  # a frequent pair ends here
        at = np.flatnonzero(follows)
        where = pair_bits(bits[codes[at - 1]], bits[codes[at]])
        pair[at] = bitmap[where >> 3] >> (where & 7).astype(np.uint8) & 1 == 1
        at = np.flatnonzero(pair[1:] & pair[:-1]) + 1
        # codes of frequent words only, so that three fit into one number
        used, small = np.unique(np.concatenate([codes[at - 2], codes[at - 1], codes[at]]), return_inverse=True)
        x, y, z = small.reshape(3, -1).astype(np.int64)
        m = max(len(used), 1)
        if m < 1 << 20:
            keys, f = counted((x * m + y) * m + z)
            x, y, z = keys // m // m, keys // m % m, keys % m
        else:
            order = np.lexsort((z, y, x))
            x, y, z = x[order], y[order], z[order]
            new = np.flatnonzero(np.append(True, (x[1:] != x[:-1]) | (y[1:] != y[:-1]) | (z[1:] != z[:-1])))
            f = np.diff(np.append(new, len(x)))
            x, y, z = x[new], y[new], z[new]
        x, y, z = used[x], used[y], used[z]
        phrase = pc.binary_join_element_wise(*(texts.take(pa.array(c, pa.int64())) for c in (x, y, z)), SPACE)
        yield from rows_of(run.langs, lang[x], phrase, f)


def places_of_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The places of given pairs in the bitmap; the columns are lang and phrase."""
    for run in runs(batches):
        codes, follows, _, _, bits = run.columns()
        at = np.flatnonzero(follows)
        yield pa.RecordBatch.from_arrays([pa.array(pair_bits(bits[codes[at - 1]], bits[codes[at]]) + 1)], names=["place"])


def bitmap_of(pairs: DataFrame) -> np.ndarray:
    """Fixed in size: PAIR_BITS bits, in parts of 4 KB."""
    places = pairs.select("lang", "phrase").mapInArrow(places_of_pairs, "place long")
    parts = places.groupBy(F.expr("bitmap_bucket_number(place)").alias("part")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(place))").alias("bits"))
    bitmap = np.zeros(PAIR_BITS // 8, dtype=np.uint8)
    for row in parts.collect():
        at = (row.part - 1) * 4096
        bitmap[at : at + 4096] = np.frombuffer(row.bits, dtype=np.uint8)
    return bitmap


def scan(columns: list[str]) -> tuple:
    """The pass over sorted slices: each phrase gets the counts of its first word and of its first two words, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word = pair = 0  # the open ones; a slice starts with its own
        for batch in batches:
            size, f = batch["size"].to_numpy(), batch["f"].to_numpy()
            at = np.arange(len(f))
            heads = []
            for order, open_ in ((1, word), (2, pair)):
                last = np.maximum.accumulate(np.where(size == order, at, -1))
                heads.append(np.where(last >= 0, f[last], open_))
            word, pair = (int(heads[0][-1]), int(heads[1][-1])) if len(f) else (word, pair)
            out = pa.Table.from_batches([batch]).append_column("one", pa.array(heads[0], pa.int64())).append_column("two", pa.array(heads[1], pa.int64()))
            yield from out.filter(pc.invert(out["is_copy"])).select([*columns, "one", "two"]).to_batches()

    return run


def with_heads(stream: DataFrame, order: list[Column], one: str, two: str) -> DataFrame:
    """``stream`` with the counts of the first word and of the first two words of each phrase, read in ``order``."""
    keys = ["lang", "k1", "k2", "k3"]
    laid = stream.withColumns(dict(zip(keys[1:], order, strict=True)))
    slices = max(1, -(-stream.count() // SLICE_ROWS))
    laid = cut(laid.repartitionByRange(slices, *keys).withColumn("slice", F.spark_partition_id()), "stream")
    columns = [c for c in laid.columns if c not in ("k1", "k2", "k3", "slice")]
    # one row a slice: what stands open at its end
    row = F.struct("k1", "k2", "k3", *columns)
    ends = cut(laid.groupBy("slice").agg(
        *(F.max(F.when(F.col("size") == n, F.struct("lang", "k1", "k2", row.alias("row")))).alias(f"open{n}") for n in (1, 2))
    ), "ends")
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = cut(ends.select("slice", *(F.last(f"open{n}", ignorenulls=True).over(before).alias(f"open{n}") for n in (1, 2))), "starts")
    copies = None
    for n in (1, 2):
        found = starts.where(f"open{n} IS NOT NULL").select("slice", f"open{n}.row.*").withColumn("is_copy", F.lit(True))
        copies = found if copies is None else copies.unionByName(found)
    whole = laid.withColumn("is_copy", F.lit(False)).unionByName(copies)
    in_order = whole.repartition(slices, "slice").sortWithinPartitions("slice", *keys)
    schema = stream.select(*columns).schema.add(one, "long").add(two, "long")
    return in_order.select(*columns, "is_copy").mapInArrow(scan(columns), schema)


def collocations(
    docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", least: int = 10, inside_percent: int = 50, first: int | None = 2000
) -> DataFrame:
    """The ``first`` (None: all) phrases of two and three words of each language by score.

    The score is floor(10^6 a^2 / (l r)) at the cut where it is lowest: a, l and r count the phrase, what stands before
    the cut and what stands behind it.  A phrase is left out if a longer one that holds it has ``inside_percent`` percent
    of its count or more.
    """
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    total = lambda df: df.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).where((F.col("f") >= least) | F.col("phrase").isNull())
    short = cut(total(texts.mapInArrow(words_and_pairs, COUNTS)), "counts")
    size = F.size(F.split("phrase", " "))
    pairs = short.where(size == 2)
    bitmap = docs.sparkSession.sparkContext.broadcast(bitmap_of(pairs))
    long = cut(total(texts.mapInArrow(lambda batches: triples(batches, bitmap.value), COUNTS)), "triples")
    stream = short.where("phrase IS NOT NULL").unionByName(long).select("lang", "phrase", "f", size.alias("size"))
    words = lambda c: [F.get(c, F.lit(i)) for i in range(3)]
    word = F.split("phrase", " ")
    ahead = cut(with_heads(stream, words(word), "first1", "first2"), "ahead")
    both = cut(with_heads(ahead, words(F.reverse(word)), "last1", "last2"), "both")
    inside = lambda longer: F.col("f") * 100 >= F.col(longer) * inside_percent
    triple = both.where("size = 3")
    part = lambda i: F.array_join(F.slice(word, i, 2), " ").alias("phrase")
    covered = triple.where(inside("first2")).select("lang", part(1)).union(triple.where(inside("last2")).select("lang", part(2))).distinct()
    kept = triple.unionByName(both.where("size = 2").join(covered.hint("merge"), ["lang", "phrase"], "left_anti").select(*both.columns))

    def at(left: str, right: str, k: int) -> Column:
        """The cut after k words; no score is over 10^6, as a is at most l and r."""
        score = F.expr(f"(1000000BD * CAST(f AS decimal(16,0)) * CAST(f AS decimal(16,0))) div (CAST({left} AS decimal(19,0)) * CAST({right} AS decimal(19,0)))")
        return F.struct(score.alias("score"), F.lit(k).alias("k"), F.col(left).alias("l"), F.col(right).alias("r"))

    lowest = F.when(F.col("size") == 2, at("first1", "last1", 1)).otherwise(F.least(at("first1", "last2", 1), at("first2", "last1", 2)))
    n = short.where("phrase IS NULL").select("lang", F.col("f").alias("n"))
    scored = cut(kept.select("lang", "phrase", F.col("f").alias("a"), lowest.alias("cut")), "scored")
    scored = scored.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    if first is not None:
        # a language is ranked in parts before its parts meet, each with no more rows than can still count
        best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
        part = F.pmod(F.xxhash64("phrase"), F.lit(64))
        near = Window.partitionBy("lang", "part").orderBy(*best)
        scored = scored.withColumn("part", part).withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= first).drop("part", "rank")
        ranks = F.row_number().over(Window.partitionBy("lang").orderBy(*best)).alias("rank")
        scored = scored.select("*", ranks).where(F.col("rank") <= first)
    else:
        scored = scored.withColumn("rank", F.lit(None).cast("int"))
    return scored.join(n, "lang").select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")


SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
g AS (
  SELECT lang, 1 AS size, unnest(ws) AS phrase FROM w
  UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) FROM w
  UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) FROM w),
n AS MATERIALIZED (SELECT lang, count(*) AS n FROM g WHERE size = 1 GROUP BY lang),
k AS MATERIALIZED (SELECT lang, size, phrase, count(*) AS f FROM g GROUP BY lang, size, phrase HAVING count(*) >= 10),
f AS MATERIALIZED (SELECT *, string_split(phrase, ' ') AS x FROM k),
c AS (SELECT lang, size, phrase, x, f, unnest(range(1, size)) AS k FROM f WHERE size > 1),
cuts AS MATERIALIZED (
  SELECT c.lang, c.size, c.phrase, c.x, c.f AS a, c.k, l.f AS l, r.f AS r,
         (1000000::HUGEINT * c.f * c.f) // (l.f::HUGEINT * r.f) AS score
  FROM c JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.x[1:c.k], ' ')
         JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.x[c.k + 1:], ' ')),
best AS MATERIALIZED (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
held AS (
  SELECT lang, f, array_to_string(x[1:2], ' ') AS phrase FROM f WHERE size = 3
  UNION ALL SELECT lang, f, array_to_string(x[2:3], ' ') FROM f WHERE size = 3),
covered AS (SELECT DISTINCT b.lang, b.phrase FROM best b JOIN held h ON h.lang = b.lang AND h.phrase = b.phrase AND 100 * h.f >= 50 * b.a)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank, b.phrase, a, l, r, n,
       score::BIGINT AS score
FROM best b JOIN n USING (lang) ANTI JOIN covered v ON v.lang = b.lang AND v.phrase = b.phrase QUALIFY rank <= 2000
"""
