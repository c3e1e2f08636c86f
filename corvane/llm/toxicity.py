"""Toxic passages as maximum-scoring segments of token log-odds.

Tokens are words, cut at everything that is not a letter or digit, and their first and last 4 to 7 bytes, so that
inflected forms share evidence.  Training counts in how many distinct texts of each label a token stands; its
log-odds have an informative Dirichlet prior whose strength is a share of the training texts, and a token counts
only if its log-odds are large and lie several standard errors above zero.  Large is a share (``least_share``) of what
a rare token of toxic texts alone can reach under the prior, which falls as the toxic share of the labels rises.
All other words take the small negative log-odds of not being such a token.  A linear scan (Kadane's, repeated in Ruzzo and Tompa's form) finds the maximal segments of
each text; the score of the best one, less the logarithm of the search space as extreme-value statistics ask, is
mapped to a probability by a logistic curve fitted on the training rows.

Defined cases: a null or empty text has no passages and takes the curve's value for no evidence; labels that are
null or belong to no document are ignored, repeated labels of a document count as toxic if one is; a document
without an id is scored but never learned from; without any labels of one kind all scores are the smoothed share
of toxic labels; other columns play no part; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from corvane.lineage import cut
from corvane.llm.memory import lean
from corvane.llm.wordhash import LOWER, letter_runs, mix, text_slices, word_bounds, word_hashes

SEPARATOR = letter_runs()
PARTS = (4, 5, 6, 7)
DOCUMENTS, WORDS = 0, 1  # counts that are kept under these numbers in place of a token's hash
COUNTS = "token long, toxic long, clean long"
FOUND = "evidence double, n_words long, passages array<struct<first:bigint,words:bigint,score:double>>"


class Model(NamedTuple):
    tokens: np.ndarray  # sorted hashes
    scores: np.ndarray
    neutral: float


def tokens_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[np.ndarray]:
    """Hashes of the whole words, then of each kind of part; a word too short for a part gives its whole hash."""
    whole = word_hashes(data, starts, ends)
    yield whole
    for n in PARTS:
        short = ends - starts <= n
        yield np.where(short, whole, mix(word_hashes(data, starts, np.minimum(starts + n, ends)), n))
        yield np.where(short, whole, mix(word_hashes(data, np.maximum(ends - n, starts), ends), 16 + n))


def _summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Values added up by key; fast when the keys are a few sorted runs."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[1:] != keys[:-1]
    first = np.flatnonzero(new)
    return (keys[first], *[np.add.reduceat(x[order], first) if len(first) else x for x in values])


class Counts:
    """How many texts of each label hold a token, kept for a bounded number of tokens at a time."""

    PENDING, MOST = 1_000_000, 1_500_000

    def __init__(self) -> None:
        self.keys, self.yes, self.both = (np.zeros(0, t) for t in (np.uint64, np.int64, np.int64))
        self.sums = {DOCUMENTS: [0, 0], WORDS: [0, 0]}
        self._pending: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, keys: np.ndarray, toxic: np.ndarray) -> None:
        self._pending.append((keys, toxic))
        if sum(len(k) for k, _ in self._pending) > self.PENDING:
            self.merge()

    def merge(self) -> None:
        if not self._pending:
            return
        keys, toxic = (np.concatenate(x) for x in zip(*self._pending, strict=True))
        self._pending = []
        new = _summed(keys, toxic, np.ones(len(keys), dtype=np.int64))
        self.keys, self.yes, self.both = _summed(*[np.concatenate(x) for x in zip((self.keys, self.yes, self.both), new, strict=True)])

    def rows(self) -> pa.RecordBatch:
        self.merge()
        token = np.concatenate([self.keys.view(np.int64), np.array(list(self.sums), dtype=np.int64)])
        yes = np.concatenate([self.yes, [x[0] for x in self.sums.values()]])
        no = np.concatenate([self.both - self.yes, [x[1] for x in self.sums.values()]])
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (token, yes, no)], names=["token", "toxic", "clean"])


def count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts of each label every token stands, with the numbers of texts and words."""
    counts = Counts()
    for batch in batches:
        labels = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        for first, last, data, offsets in text_slices(batch.column(1)):
            data = LOWER[data]
            starts, ends, first_word = word_bounds(data, offsets, SEPARATOR)
            per_row, own = np.diff(first_word), labels[first:last]
            for i, label in enumerate((1, 0)):
                counts.sums[DOCUMENTS][i] += int((own == label).sum())
                counts.sums[WORDS][i] += int(per_row[own == label].sum())
            row = np.repeat(np.arange(last - first), per_row)
            every = np.concatenate(list(tokens_of(data, starts, ends)))
            salt = np.tile(np.uint64(0x9E3779B97F4A7C15) * row.astype(np.uint64), 1 + 2 * len(PARTS))
            once = np.unique(mix(every + salt), return_index=True)[1]
            counts.add(every[once], own[row[once % max(len(row), 1)]])
            if len(counts.keys) > Counts.MOST:
                yield counts.rows()
                counts = Counts()
    yield counts.rows()


def learn(texts: DataFrame, *, prior_share: float = 0.1, errors: float = 3.5, least_share: float = 0.64) -> Model | None:
    """All significant tokens of ``texts`` (columns ``toxic`` and ``text``), as many as the sample of labelled rows can hold."""
    counts = cut(
        texts.select("toxic", "text").mapInArrow(lean(count_tokens), COUNTS)
        .groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")),
        "tokens",
    )
    sums = {r.token: (r.toxic, r.clean) for r in counts.where(F.col("token").isin(DOCUMENTS, WORDS)).collect()}
    (n1, n0), (w1, w0) = sums.get(DOCUMENTS, (0, 0)), sums.get(WORDS, (0, 0))
    if not n1 or not n0:
        return None
    strength = prior_share * (n1 + n0)
    prior = (F.col("toxic") + F.col("clean")) * prior_share
    odds = lambda y, n: F.log((y + prior) / (n + strength - y - prior))
    ceiling = math.log(1 + 1 / prior_share) + math.log((n0 + strength) / (n1 + strength))
    judged = counts.where(~F.col("token").isin(DOCUMENTS, WORDS) & (F.col("toxic") * n0 > F.col("clean") * n1)).select(
        "token", "toxic", "clean", (odds(F.col("toxic"), n1) - odds(F.col("clean"), n0)).alias("score"),
        F.sqrt(1 / (F.col("toxic") + prior) + 1 / (F.col("clean") + prior)).alias("error"),
    )
    sure = judged.where((F.col("score") >= errors * F.col("error")) & (F.col("score") >= least_share * ceiling))
    rows = sure.select("token", "toxic", "clean", "score").toArrow()
    token, toxic, clean, score = (rows[c].to_numpy() for c in rows.column_names)
    order = np.argsort(token.view(np.uint64))
    share1 = min(0.5, int(toxic.sum()) / max(w1, 1) / (1 + 2 * len(PARTS)))
    share0 = min(share1, int(clean.sum()) / max(w0, 1) / (1 + 2 * len(PARTS)))
    return Model(
        token.view(np.uint64)[order],
        score[order],
        min(-0.01, math.log((1 - share1) / (1 - share0))),
    )


def maximal_segments(positions: list[int], scores: list[float], neutral: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, after the last, score) of a sequence given by its positive places."""
    found: list[list] = []  # [first, after, sum before, sum after]
    total, last = 0.0, 0
    for at, score in zip(positions, scores, strict=True):
        total += neutral * (at - last)
        segment = [at, at + 1, total, total + score]
        total, last = segment[3], at + 1
        while True:
            below = len(found) - 1
            while below >= 0 and found[below][2] >= segment[2]:
                below -= 1
            if below < 0 or found[below][3] >= segment[3]:
                found.append(segment)
                break
            segment = [found[below][0], segment[1], found[below][2], segment[3]]
            del found[below:]
    return [(a, b, end - begin) for a, b, begin, end in found]


def scorer(model: Model, search_share: float):
    """Evidence, number of words and significant passages of each text of a column."""
    maybe = np.zeros(1 << 16, dtype=bool)
    maybe[(model.tokens >> np.uint64(48)).astype(np.int64)] = True

    def score(texts: pa.Array) -> pa.StructArray:
        evidence, n_words, passages = [], [], []
        for first, last, data, offsets in text_slices(texts):
            data = LOWER[data]
            starts, ends, first_word = word_bounds(data, offsets, SEPARATOR)
            best = np.zeros(len(starts))
            for hashes in tokens_of(data, starts, ends):
                at = np.flatnonzero(maybe[(hashes >> np.uint64(48)).astype(np.int64)])
                place = np.minimum(np.searchsorted(model.tokens, hashes[at]), max(len(model.tokens) - 1, 0))
                if len(at):
                    hit = model.tokens[place] == hashes[at]
                    best[at[hit]] = np.maximum(best[at[hit]], model.scores[place[hit]])
            hits = np.flatnonzero(best)
            cuts = np.searchsorted(hits, first_word)
            for row in range(last - first):
                m = int(first_word[row + 1] - first_word[row])
                own = hits[cuts[row] : cuts[row + 1]]
                space = math.log(max(1.0, search_share * m))
                segments = maximal_segments((own - first_word[row]).tolist(), best[own].tolist(), model.neutral)
                sure = [(a, b, s - space) for a, b, s in segments if s > space]
                evidence.append(max((s for _, _, s in sure), default=0.0))
                n_words.append(m)
                passages.append([{"first": a, "words": b - a, "score": s} for a, b, s in sure])
        kind = pa.list_(pa.struct([("first", pa.int64()), ("words", pa.int64()), ("score", pa.float64())]))
        columns = [pa.array(evidence, pa.float64()), pa.array(n_words, pa.int64()), pa.array(passages, kind)]
        return pa.StructArray.from_arrays(columns, ["evidence", "n_words", "passages"])

    return score


def fit_curve(x: np.ndarray, toxic: np.ndarray, clean: np.ndarray, ridge: float = 0.05) -> tuple[float, float]:
    """Intercept and slope of a logistic curve through counted values, by Newton's method with a small ridge."""
    w = np.zeros(2)
    design = np.stack([np.ones_like(x), x], axis=1)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        weight = (toxic + clean) * p * (1 - p)
        gradient = design.T @ (toxic - (toxic + clean) * p) - ridge * w
        step = np.linalg.solve(design.T @ (design * weight[:, None]) + ridge * np.eye(2), gradient)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def free_name(name: str, taken: list[str]) -> str:
    """``name``, with as many underscores behind it as make it differ from all columns ``taken``."""
    while name.lower() in {x.lower() for x in taken}:
        name += "_"
    return name


def find(docs: DataFrame, text_col: str, keep: list[str], model: Model, search_share: float, found_col: str = "__found") -> DataFrame:
    """The columns ``keep`` of each row and, as a struct ``found_col``, what its text shows."""
    score = scorer(model, search_share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = score(batch.column(0))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], found], names=[*keep, found_col])

    rows = docs.select(F.col(f"`{text_col}`").alias(free_name("__text", keep)), *[F.col(f"`{c}`") for c in keep])
    schema = StructType([docs.schema[c] for c in keep]).add(found_col, StructType.fromDDL(FOUND))
    return rows.mapInArrow(lean(run), schema)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    learn_from: Column,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    search_share: float = 0.01,
    most_broadcast: int = 1_000_000,
    most_labels: int = 1_000_000,
) -> tuple[Model, tuple[float, float]]:
    """The tokens and the curve from the labelled rows that ``learn_from``, a condition on ``doc_id``, admits.

    Beyond ``most_labels`` labelled ids the model is fitted on a sample of about that many, drawn by a hash of the id, which
    bounds all that is collected.  The labels are broadcast up to ``most_broadcast`` rows and joined by a shuffle beyond;
    the result is the same.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    known = cut(
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("long").alias("toxic"))
        .where(learn_from),
        "labels",
    )
    n = known.count()
    if n > most_labels:
        draw = F.pmod(F.xxhash64("doc_id", F.lit("labelled")), F.lit(1 << 30))
        known, n = known.where(draw < F.lit(int(most_labels / n * (1 << 30)))), most_labels
    side = F.broadcast(known) if n <= most_broadcast else known
    train = cut(
        texts.join(side, "doc_id").groupBy(F.xxhash64("text").alias("h"), "toxic").agg(F.first("text").alias("text")),
        "labelled",
    )
    model = learn(train)
    if model is None:
        n, yes = known.agg(F.count("toxic"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
        return Model(np.zeros(0, np.uint64), np.zeros(0), -0.01), (math.log((yes + 0.5) / (n - yes + 0.5)) if n else -10.0, 0.0)
    bins = (
        find(train, "text", ["toxic"], model, search_share)
        .groupBy(F.least(F.round("__found.evidence", 1), F.lit(100.0)).alias("x"))
        .agg(F.sum("toxic").alias("yes"), F.sum(1 - F.col("toxic")).alias("no"))
        .collect()
    )
    return model, fit_curve(*(np.array([float(r[i]) for r in bins]) for i in range(3)))


def score_of(curve: tuple[float, float], found_col: str) -> Column:
    value = F.lit(curve[0]) + F.lit(curve[1]) * F.least(f"{found_col}.evidence", F.lit(100.0))
    return 1 / (1 + F.exp(-value))


def toxicity(
    docs: DataFrame, labels: DataFrame, learn_from: Column, *, text_col: str = "text", search_share: float = 0.01, **options
) -> DataFrame:
    """Every row of ``docs`` without its text, with its ``score``, the significant ``passages`` and ``n_words``."""
    model, curve = fit(docs, labels, learn_from, text_col=text_col, search_share=search_share, **options)
    keep = [c for c in docs.columns if c not in (text_col, "score", "passages", "n_words")]
    column = free_name("__found", keep)
    found = find(docs, text_col, keep, model, search_share, column)
    return found.select(*[f"`{c}`" for c in keep], score_of(curve, column).alias("score"), f"{column}.passages", f"{column}.n_words")


def keep_clean(
    docs: DataFrame, labels: DataFrame, learn_from: Column, *, least: float = 0.5, text_col: str = "text",
    search_share: float = 0.01, **options,
) -> DataFrame:
    """The rows of ``docs`` whose text scores below ``least``, unchanged."""
    model, curve = fit(docs, labels, learn_from, text_col=text_col, search_share=search_share, **options)
    column = free_name("__found", docs.columns)
    found = find(docs, text_col, docs.columns, model, search_share, column)
    return found.where(score_of(curve, column) < least).select(*[f"`{c}`" for c in docs.columns])
