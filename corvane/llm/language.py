"""Language of a text by unigram pieces, summed over all ways to cut its words into pieces.

The pieces are those of a fixed public vocabulary, in lower case, with every single byte, so each word can be cut.
Each language has a probability for each piece, learnt by expectation-maximisation: the forward and backward
sums over all segmentations of a word give how often each piece is expected in it.  A text's score under a language is
the sum over its words of the logarithm of the forward sum.  Words are cut at everything that is not a letter or
digit and scored whole, whatever their length: the sums of a long word are scaled anew every 32 bytes.  Pieces of every
length take part.  Distinct words are scored once in a run.

The model is fitted on a sample of at most about ``sample`` texts of each language, drawn by a hash of the id; there
alone, words are cut before the character that would pass ``FIT_RUN`` bytes.  All else covers all rows.

Defined cases: a text that is null or has no letter is ``und`` with score 0, and so is every text when no language
could be learnt; a row without an id is predicted but never learnt from; ties go to the first language in
alphabetical order; other columns play no part; an empty table gives an empty table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from corvane.llm.wordhash import LOWER, letter_runs, text_slices, word_bounds, word_hashes

SEPARATOR = letter_runs()
SHORT_PIECE, FIT_RUN = 8, 256  # pieces up to the first lie in one table, the few longer ones in a list
SCALED_EVERY = 32
UNIT = 12.0  # a factor for each byte that keeps forward sums near one
AT_ONCE, MOST_WORDS = 40_000, 1_000_000


def pieces_of(tokenizer: str) -> list[bytes]:
    """Distinct lower-case pieces of a byte-level vocabulary file that are made of letters, and all single bytes."""
    spelt = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # bytes that stand for themselves there
    rest = [b for b in range(256) if b not in spelt]
    byte = {chr(b): b for b in spelt} | {chr(256 + i): b for i, b in enumerate(rest)}
    with open(tokenizer, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    pieces = {bytes([b]) for b in range(256)}
    for piece in vocabulary:
        if all(c in byte for c in piece):
            raw = bytes(LOWER[b] for b in (byte[c] for c in piece)).lstrip(b" ")
            if len(raw) > 1 and not any(SEPARATOR[b] for b in raw):
                pieces.add(raw)
    return sorted(pieces)


class Vocabulary:
    def __init__(self, pieces: list[bytes]) -> None:
        data = np.frombuffer(b"".join(pieces), np.uint8)
        ends = np.cumsum([len(p) for p in pieces])
        hashes = word_hashes(data, ends - [len(p) for p in pieces], ends)
        order = np.argsort(hashes)
        self.size, self._hashes, self._ids = len(pieces), hashes[order], order
        self.lengths = np.array([len(p) for p in pieces])
        self._long = [int(n) for n in np.unique(self.lengths) if n > SHORT_PIECE]
        self._maybe = np.zeros(1 << 16, dtype=bool)
        self._maybe[(self._hashes >> np.uint64(48)).astype(np.int64)] = True

    def ids(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The short piece of each length at each byte (row length - 1), or ``size`` where there is none; bytes at
        which longer pieces start, and these pieces."""
        found = np.full((SHORT_PIECE, len(data)), self.size, dtype=np.int64)
        left = np.repeat(ends, ends - starts) - np.arange(len(data))
        places, longer = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        room = np.arange(len(data))
        for n in [*range(1, SHORT_PIECE + 1), *self._long]:
            room = room[left[room] >= n]
            hashes = word_hashes(data, room, room + n)
            some = self._maybe[(hashes >> np.uint64(48)).astype(np.int64)]
            at, hashes = room[some], hashes[some]
            place = np.minimum(np.searchsorted(self._hashes, hashes), self.size - 1)
            hit = self._hashes[place] == hashes
            if n <= SHORT_PIECE:
                found[n - 1, at[hit]] = self._ids[place[hit]]
            else:
                places.append(at[hit])
                longer.append(self._ids[place[hit]])
        return found, np.concatenate(places), np.concatenate(longer)


class Words:
    """Runs of bytes laid one after the other, longest first, and the lattice of their pieces."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, vocabulary: Vocabulary) -> None:
        sizes = ends - starts
        self.order = np.argsort(-sizes, kind="stable")
        self.sizes = sizes[self.order]
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        index = np.arange(self.sizes.sum()) + np.repeat(starts[self.order] - self.starts, self.sizes)
        self.pieces, at, ids = vocabulary.ids(data[index], self.starts, self.ends)
        self.first = self.starts + np.arange(len(sizes))  # of the places between bytes, one more than bytes
        word = np.searchsorted(self.ends, at, side="right")
        length = vocabulary.lengths[ids]
        self.reach = max(SHORT_PIECE, int(length.max(initial=0)))
        steps = np.arange(int(self.sizes[0]) + 2 if len(sizes) else 1)
        begin = at - self.starts[word]

        def sorted_by(key: np.ndarray) -> tuple[np.ndarray, ...]:
            order = np.argsort(key, kind="stable")
            return *(x[order] for x in (word, self.first[word] + begin, length, ids)), np.searchsorted(key[order], steps)

        self.by_end, self.by_start = sorted_by(begin + length), sorted_by(begin)

    def forward(self, p: np.ndarray, logs: np.ndarray | None = None) -> np.ndarray:
        """Sums over all segmentations up to each place; p has a row per piece, one of zeros at the end.

        With ``logs`` (a row per word, longest first) long words are scaled on the way and it takes the logarithms.
        """
        sums = np.zeros((len(self.pieces[0]) + len(self.sizes), p.shape[1]))
        sums[self.first] = 1
        _, places, lengths, ids, bounds = self.by_end
        for j in range(1, int(self.sizes[0]) + 1 if len(self.sizes) else 1):
            n = int(np.searchsorted(-self.sizes, -j, side="right"))
            at, byte = self.first[:n], self.starts[:n]
            for size in range(1, min(j, SHORT_PIECE) + 1):
                sums[at + j] += sums[at + j - size] * p[self.pieces[size - 1, byte + j - size]]
            some = slice(bounds[j], bounds[j + 1])
            if some.start < some.stop:
                np.add.at(sums, places[some] + lengths[some], sums[places[some]] * p[ids[some]])
            if logs is not None and j % SCALED_EVERY == 0:
                rows = self.first[: int(np.searchsorted(-self.sizes, -(j + 1), side="right"))] + j
                factor = np.maximum(sums[rows], 1e-300)
                logs[: len(rows)] += np.log(factor)
                for back in range(min(self.reach, j) + 1 if len(rows) else 0):
                    sums[rows - back] = np.minimum(sums[rows - back] / factor, 1e250)
        return sums

    def expected(self, p: np.ndarray, times: np.ndarray) -> np.ndarray:
        """How often each piece is expected when each word stands ``times``; p as in ``forward`` for one language."""
        sums = self.forward(p)[:, 0]
        back = np.zeros(len(sums))
        back[self.first + self.sizes] = 1
        counts = np.zeros(len(p))
        whole = times[self.order] / np.maximum(sums[self.first + self.sizes], 1e-300)
        words, places, lengths, longer, bounds = self.by_start
        for j in range(int(self.sizes[0]) - 1 if len(self.sizes) else -1, -1, -1):
            n = int(np.searchsorted(-self.sizes, -(j + 1), side="right"))
            at, byte = self.first[:n], self.starts[:n]
            for size in range(1, SHORT_PIECE + 1):
                m = int(np.searchsorted(-self.sizes[:n], -(j + size), side="right"))
                if not m:
                    break
                ids = self.pieces[size - 1, byte[:m] + j]
                part = p[ids, 0] * back[at[:m] + j + size]
                back[at[:m] + j] += part
                counts += np.bincount(ids, weights=part * sums[at[:m] + j] * whole[:m], minlength=len(counts))
            some = slice(bounds[j], bounds[j + 1])
            if some.start < some.stop:
                part = p[longer[some], 0] * back[places[some] + lengths[some]]
                np.add.at(back, places[some], part)
                np.add.at(counts, longer[some], part * sums[places[some]] * whole[words[some]])
        return counts

    def scores(self, p: np.ndarray) -> np.ndarray:
        """Logarithm of the forward sum of each word, in the order given."""
        out = np.empty((len(self.sizes), p.shape[1]))
        logs = np.zeros_like(out)
        sums = self.forward(p, logs)[self.first + self.sizes]
        out[self.order] = logs + np.log(np.maximum(sums, 1e-300)) - (self.sizes * np.log(UNIT))[:, None]
        return out


def fit_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words, long ones in runs of whole characters."""
    starts, ends, _ = word_bounds(data, offsets, SEPARATOR)
    cuts = []
    for start, end in zip(*(x[ends - starts > FIT_RUN].tolist() for x in (starts, ends)), strict=True):
        while end - start > FIT_RUN:
            start += FIT_RUN
            start -= next((k for k in range(4) if data[start - k] & 0xC0 != 0x80), 0)
            cuts.append(start)
    return np.sort(np.append(starts, cuts)).astype(starts.dtype), np.sort(np.append(ends, cuts)).astype(ends.dtype)


def fit_language(texts: pa.ChunkedArray, vocabulary: Vocabulary, rounds: int, prior: float) -> np.ndarray:
    """Log probabilities of the pieces in one language."""
    kept: dict[int, list] = {}
    for _, _, data, offsets in text_slices(texts, 1 << 20):
        data = LOWER[data]
        starts, ends = fit_runs(data, offsets)
        codes, distinct = pd.factorize(word_hashes(data, starts, ends))
        at = np.full(len(distinct), -1)
        at[codes[::-1]] = np.arange(len(codes))[::-1]
        for h, i, n in zip(distinct.tolist(), at.tolist(), np.bincount(codes, minlength=len(distinct)).tolist(), strict=True):
            if h in kept:
                kept[h][1] += n
            else:
                kept[h] = [data[starts[i] : ends[i]].tobytes(), n]
    words, times = [x[0] for x in kept.values()], np.array([x[1] for x in kept.values()], dtype=float)
    p = np.append(np.exp(-1.5 * vocabulary.lengths), 0)[:, None]
    for _ in range(rounds):
        counts = np.full(vocabulary.size + 1, prior)
        scaled = p * np.append(UNIT**vocabulary.lengths, 0)[:, None]
        for i in range(0, len(words), AT_ONCE):
            part = words[i : i + AT_ONCE]
            ends = np.cumsum([len(w) for w in part])
            lattice = Words(np.frombuffer(b"".join(part), np.uint8), ends - [len(w) for w in part], ends, vocabulary)
            counts += lattice.expected(scaled, times[i : i + AT_ONCE])
        counts[-1] = 0
        p = (counts / counts.sum())[:, None]
    return np.log(p[:-1, 0])


class Scorer:
    """Scores of words by their hash, kept for the tasks of one run."""

    def __init__(self, pieces: list[bytes], logs: np.ndarray) -> None:
        self._vocabulary = Vocabulary(pieces)
        scale = self._vocabulary.lengths[:, None] * np.log(UNIT)
        self._p = np.vstack([np.exp(logs + scale), np.zeros((1, logs.shape[1]))])
        self._forget()

    def _forget(self) -> None:
        self._keys = np.zeros(0, dtype=np.uint64)
        self._scores = np.zeros((0, self._p.shape[1]), dtype=np.float32)

    def texts(self, column: pa.Array) -> np.ndarray:
        out = [np.zeros((0, self._p.shape[1]))]
        for _, _, data, offsets in text_slices(column, 1 << 20):
            data = LOWER[data]
            starts, ends, first = word_bounds(data, offsets, SEPARATOR)
            scores = self._of(data, starts, ends)
            total = np.concatenate([np.zeros((1, self._p.shape[1])), np.cumsum(scores, axis=0, dtype=np.float64)])
            out.append(total[first[1:]] - total[first[:-1]])
        return np.concatenate(out)

    def _of(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        codes, distinct = pd.factorize(word_hashes(data, starts, ends))
        if len(self._keys) + len(distinct) > MOST_WORDS:
            self._forget()
        place = np.minimum(np.searchsorted(self._keys, distinct), max(len(self._keys) - 1, 0))
        new = np.flatnonzero(self._keys[place] != distinct) if len(self._keys) else np.arange(len(distinct))
        if len(new):
            at = np.full(len(distinct), -1)
            at[codes[::-1]] = np.arange(len(codes))[::-1]
            found = [np.zeros((0, self._p.shape[1]), np.float32)]
            for i in range(0, len(new), AT_ONCE):
                some = at[new[i : i + AT_ONCE]]
                found.append(Words(data, starts[some], ends[some], self._vocabulary).scores(self._p).astype(np.float32))
            keys = np.concatenate([self._keys, distinct[new]])
            order = np.argsort(keys, kind="stable")
            self._keys, self._scores = keys[order], np.concatenate([self._scores, *found])[order]
            place = np.searchsorted(self._keys, distinct)
        return self._scores[place][codes]


_scorer: tuple[str, Scorer] | None = None


def detect(
    docs: DataFrame, tokenizer: str, learn_from: Column, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    sample: int = 1500, rounds: int = 4, prior: float = 0.05,
) -> DataFrame:
    """(doc_id, lang_pred, score) for every row; ``learn_from`` is a condition on the columns of ``docs``."""
    spark = docs.sparkSession
    pieces = pieces_of(tokenizer)
    known = docs.where(learn_from & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
    sizes = known.groupBy(F.col(lang_col).alias("lang")).count().collect()
    langs = sorted(r.lang for r in sizes)
    if langs:
        share = F.coalesce(*[F.when(F.col(lang_col) == r.lang, F.lit(min(1.0, sample / r["count"]))) for r in sizes])
        draw = F.pmod(F.xxhash64(F.col(id_col).cast("long"), F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
        chosen = known.where(draw < share).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
        vocabulary_of = spark.sparkContext.broadcast(pieces)

        def fit(table: pa.Table) -> pa.Table:
            logs = fit_language(table["text"], Vocabulary(vocabulary_of.value), rounds, prior)
            return pa.table({"lang": pa.array([table["lang"][0].as_py()]), "logs": pa.array([logs.tolist()], pa.list_(pa.float64()))})

        fitted = {r.lang: r.logs for r in chosen.groupBy("lang").applyInArrow(fit, "lang string, logs array<double>").collect()}
        langs = [x for x in langs if x in fitted]
    if not langs:
        return docs.select(F.col(id_col).alias("doc_id"), F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = spark.sparkContext.broadcast((uuid.uuid4().hex, pieces, np.array([fitted[x] for x in langs]).T, langs))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        global _scorer
        run, pieces, logs, names = shared.value
        if _scorer is None or _scorer[0] != run:
            _scorer = (run, Scorer(pieces, logs))
        for batch in batches:
            scores = _scorer[1].texts(batch.column(1))
            best = scores.argmax(axis=1)
            odds = np.exp(scores - scores.max(axis=1, keepdims=True)).sum(axis=1)
            lang = pa.array(np.array(names, dtype=object)[best], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), lang, pa.array(1 / odds, pa.float64()), batch.column(2)], names=["doc_id", "lang_pred", "score", "real"])

    real = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), real.alias("real"))
    found = rows.mapInArrow(predict, "doc_id long, lang_pred string, score double, real boolean")
    return found.select(
        "doc_id", F.when(F.col("real"), F.col("lang_pred")).otherwise("und").alias("lang_pred"),
        F.when(F.col("real"), F.col("score")).otherwise(0.0).alias("score"),
    )
