"""Repeated passages: every window of ``length`` words that starts earlier somewhere else, found exactly.

Two operators share the exchange in this module and differ in the positions they look at first:

- ``cover_anchors`` (substring dedup) hashes short windows only at positions of a difference cover modulo a
  period.  Any two equal passages of ``length`` words, however they are aligned, share an anchor.
- ``minimiser_anchors`` (sparse suffix arrays) keeps the suffixes that start at content-selected minimiser
  positions.  Their leading words are brought into sorted order, neighbours are compared, and matches extend.

Work flows between two partitionings.  A *chunk* holds whole documents, dealt by a hash of the id; a *bucket*
holds a range of hash values.  A chunk sends each bucket one sorted, locally distinct run of hashes, so a passage
that a third of all documents share is one entry per chunk.  The bucket compares sorted neighbours of all chunks
and answers with one bit per entry, in the order sent; the chunk computes the same order again from its text.

1. Anchors go out; the answer says which occur anywhere else.
2. Every window around a shared anchor is an extension to full length.  Windows go out as 96-bit hashes with the
   smallest id of the chunk; the answer says whether another chunk has a smaller id.
3. Words under a window that starts earlier elsewhere are removed.

Defined cases: a null text has no words; rows with the same id count as ordered by text, a null id comes before
all others; other columns are passed through untouched, whatever their names; repeated rows lose every
passage but the first; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from corvane.llm.memory import give_back
from corvane.llm.wordhash import inside_rows, text_slices, window_checks, windows, word_bounds, word_hashes

COVER_PERIOD, COVER = 13, (0, 1, 3, 9)  # fixed values: every difference modulo 13 occurs between two members

AnchorsOf = Callable[[np.ndarray, np.ndarray, int], tuple[np.ndarray, np.ndarray, int]]


def cover_anchors(hashes: np.ndarray, first_word: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Positions in the cover, the hash of the window there, and how many words it has."""
    words = length - COVER_PERIOD + 1
    if words < 1:
        raise ValueError(f"passages must have at least {COVER_PERIOD} words")
    values = windows(hashes, words)
    position = np.arange(len(hashes)) - np.repeat(first_word[:-1], np.diff(first_word))
    chosen = np.isin(np.arange(COVER_PERIOD), COVER)[position % COVER_PERIOD] & inside_rows(first_word, len(hashes), words)
    at = np.flatnonzero(chosen[: len(values)])
    return at, values[at], words


def _sliding(a: np.ndarray, n: int, best: np.ufunc) -> np.ndarray:
    """Minimum or maximum of n neighbours, by doubling."""
    reach = 1
    while reach < n:
        step = min(reach, n - reach)
        a = best(a[:-step], a[step:])
        reach += step
    return a


def minimiser_anchors(hashes: np.ndarray, first_word: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Suffixes kept: in each passage of ``length`` words, where the hash of half as many words is smallest."""
    words = max(1, length // 2)
    reach = length - words + 1
    values = windows(hashes, words)
    if len(hashes) < length:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64), words
    values[~inside_rows(first_word, len(hashes), words)[: len(values)]] = np.uint64(2**64 - 1)
    smallest = _sliding(values, reach, np.minimum)
    smallest[~inside_rows(first_word, len(hashes), length)[: len(smallest)]] = 0
    padded = np.zeros(len(smallest) + 2 * (reach - 1), dtype=np.uint64)
    padded[reach - 1 : reach - 1 + len(smallest)] = smallest
    at = np.flatnonzero(_sliding(padded, reach, np.maximum) == values)
    return at, values[at], words


class Chunk:
    """The documents of one chunk in order, their word hashes and their anchors."""

    def __init__(self, table: pa.Table, length: int, anchors_of: AnchorsOf) -> None:
        ids = table["id"].combine_chunks().fill_null(np.iinfo(np.int64).min)
        order = np.argsort(ids.to_numpy(zero_copy_only=False), kind="stable")
        if len(np.unique(ids)) < len(ids):
            order = pc.sort_indices(
                pa.table({"id": ids, "text": table["text"]}), [("id", "ascending"), ("text", "ascending")]
            )
        self.table = table.take(pa.array(order))
        self.ids = ids.to_numpy(zero_copy_only=False)[np.asarray(order)]
        hashes, first = [np.zeros(0, dtype=np.uint64)], [np.zeros(1, dtype=np.int64)]
        seen = 0
        for _, _, data, offsets in text_slices(self.table["text"]):
            starts, ends, first_word = word_bounds(data, offsets)
            hashes.append(word_hashes(data, starts, ends))
            first.append(first_word[1:] + seen)
            seen += len(starts)
        self.length = length
        self.hashes, self.first_word = np.concatenate(hashes), np.concatenate(first)
        self.at, values, self.anchor_words = anchors_of(self.hashes, self.first_word, length)
        self.anchors, self.of_anchor, counts = np.unique(values, return_inverse=True, return_counts=True)
        self.here_twice = counts > 1

    def candidates(self, elsewhere: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Window positions around shared anchors, sorted by hash, with the number of the distinct window of each.

        Returns positions, the first entry of each distinct window, the number of each entry, hashes and checks.
        """
        shared = self.at[(elsewhere | self.here_twice)[self.of_anchor]]
        steps = np.zeros(len(self.hashes) + 1, dtype=np.int32)
        np.add.at(steps, np.maximum(shared - (self.length - self.anchor_words), 0), 1)
        np.add.at(steps, shared + 1, -1)
        near = (np.cumsum(steps[:-1]) > 0) & inside_rows(self.first_word, len(self.hashes), self.length)
        at = np.flatnonzero(near)
        if not len(at):
            none = np.zeros(0, dtype=np.int64)
            return none, none, none, none.astype(np.uint64), none.astype(np.uint32)
        values, checks = windows(self.hashes, self.length)[at], window_checks(self.hashes, self.length)[at]
        order = np.argsort(values, kind="stable")
        at, values, checks = at[order], values[order], checks[order]
        new = np.ones(len(at), dtype=bool)
        new[1:] = (values[1:] != values[:-1]) | (checks[1:] != checks[:-1])
        return at, np.flatnonzero(new), np.cumsum(new) - 1, values, checks

    def id_at(self, positions: np.ndarray) -> np.ndarray:
        return self.ids[np.searchsorted(self.first_word, positions, side="right") - 1]


def _cuts(sorted_values: np.ndarray, n: int) -> np.ndarray:
    """Where a sorted run of hashes is cut into n ranges of the hash space."""
    edges = np.array([(i << 64) // n for i in range(1, n)], dtype=np.uint64)
    return np.concatenate([[0], np.searchsorted(sorted_values, edges, side="left"), [len(sorted_values)]])


def _runs(chunk: int, n: int, values: np.ndarray, checks: np.ndarray | None = None, ids: np.ndarray | None = None) -> pa.Table:
    cuts = _cuts(values, n)
    full = np.flatnonzero(np.diff(cuts))
    part = lambda a: [a[cuts[b] : cuts[b + 1]].tobytes() for b in full] if a is not None else [b""] * len(full)
    return pa.table(
        {
            "bucket": pa.array(full, pa.int32()),
            "chunk": pa.array([chunk] * len(full), pa.int32()),
            "hashes": pa.array(part(values), pa.binary()),
            "checks": pa.array(part(checks), pa.binary()),
            "ids": pa.array(part(ids), pa.binary()),
        }
    )


RUNS = "bucket int, chunk int, hashes binary, checks binary, ids binary"
ANSWERS = "chunk int, kind int, bucket int, bits binary"


def _joined(column: pa.ChunkedArray, dtype: type) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), dtype=dtype) if x.is_valid else np.zeros(0, dtype) for x in column]


def _answers(table: pa.Table, kind: int, flags: list[np.ndarray]) -> pa.Table:
    return pa.table(
        {
            "chunk": table["chunk"].combine_chunks(),
            "kind": pa.array([kind] * len(table), pa.int32()),
            "bucket": table["bucket"].combine_chunks(),
            "bits": pa.array([np.packbits(x).tobytes() for x in flags], pa.binary()),
        }
    )


def compare_anchors(table: pa.Table) -> pa.Table:
    """For each run of a bucket, which of its hashes stand in another run too."""
    runs = _joined(table["hashes"], np.uint64)
    every = np.sort(np.concatenate(runs))
    twice = every[1:][every[1:] == every[:-1]]
    flags = []
    for run in runs:
        place = np.searchsorted(twice, run)
        flags.append(twice[np.minimum(place, max(len(twice) - 1, 0))] == run if len(twice) else np.zeros(len(run), bool))
    return _answers(table, 0, flags)


def compare_windows(table: pa.Table) -> pa.Table:
    """For each run of a bucket, which of its windows another run has with a smaller id."""
    runs = _joined(table["hashes"], np.uint64)
    values, checks = np.concatenate(runs), np.concatenate(_joined(table["checks"], np.uint32))
    ids = np.concatenate(_joined(table["ids"], np.int64))
    order = np.lexsort((ids, checks, values))
    v, c, i = values[order], checks[order], ids[order]
    new = np.ones(len(v), dtype=bool)
    new[1:] = (v[1:] != v[:-1]) | (c[1:] != c[:-1])
    later = np.zeros(len(v), dtype=bool)
    later[order] = i > i[new][np.cumsum(new) - 1]
    return _answers(table, 1, np.split(later, np.cumsum([len(x) for x in runs])[:-1]))


def _flags(answers: pa.Table, kind: int, values: np.ndarray, n: int) -> np.ndarray:
    """The bits that came back, laid along the run that went out."""
    flags = np.zeros(len(values), dtype=bool)
    cuts = _cuts(values, n)
    of_kind = answers.filter(pc.equal(answers["kind"], kind))
    for bucket, bits in zip(of_kind["bucket"].to_pylist(), of_kind["bits"], strict=True):
        size = cuts[bucket + 1] - cuts[bucket]
        flags[cuts[bucket] : cuts[bucket + 1]] = np.unpackbits(np.frombuffer(bits.as_buffer(), np.uint8), count=size)
    return flags


def send_anchors(chunk: int, table: pa.Table, *, length: int, anchors_of: AnchorsOf, buckets: int) -> pa.Table:
    return _runs(chunk, buckets, Chunk(table, length, anchors_of).anchors)


def send_windows(
    number: int, table: pa.Table, answers: pa.Table, *, length: int, anchors_of: AnchorsOf, buckets: int
) -> pa.Table:
    if not len(table):
        return _runs(0, buckets, np.zeros(0, dtype=np.uint64))
    chunk = Chunk(table, length, anchors_of)
    at, first, _, values, checks = chunk.candidates(_flags(answers, 0, chunk.anchors, buckets))
    return _runs(number, buckets, values[first], checks[first], chunk.id_at(at[first]))


def _joined_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, row: np.ndarray, rows: int) -> pa.Array:
    """The given words of each row, joined by one space."""
    sizes = ends - starts + 1
    out = np.concatenate([[0], np.cumsum(sizes)])
    index = np.arange(out[-1]) + np.repeat(starts - out[:-1], sizes)
    text = data[np.minimum(index, max(len(data) - 1, 0))] if len(data) else np.zeros(0, np.uint8)
    text[out[1:] - 1] = 0x20
    per_row = np.zeros(rows, dtype=np.int64)
    np.add.at(per_row, row, sizes)
    keep = np.ones(len(text), dtype=bool)
    bounds = np.concatenate([[0], np.cumsum(per_row)])
    keep[bounds[1:][per_row > 0] - 1] = False
    bounds -= np.concatenate([[0], np.cumsum(per_row > 0)])
    return pa.LargeStringArray.from_buffers(rows, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(text[keep]))


def remove_repeats(
    table: pa.Table, answers: pa.Table, *, length: int, anchors_of: AnchorsOf, buckets: int, join_words: bool, schema: pa.Schema
) -> pa.Table:
    if not len(table):
        return schema.empty_table()
    chunk = Chunk(table, length, anchors_of)
    at, first, number, values, _ = chunk.candidates(_flags(answers, 0, chunk.anchors, buckets))
    again = np.ones(len(at), dtype=bool)
    again[first] = _flags(answers, 1, values[first], buckets)
    steps = np.zeros(len(chunk.hashes) + 1, dtype=np.int32)
    np.add.at(steps, at[again], 1)
    np.add.at(steps, at[again] + length, -1)
    removed = np.cumsum(steps[:-1]) > 0
    rows = len(chunk.table)
    totals = np.concatenate([[0], np.cumsum(removed)])
    n_removed = totals[chunk.first_word[1:]] - totals[chunk.first_word[:-1]]
    texts, seen, span_rows = [], 0, [[] for _ in range(rows)]
    for begin, end, data, offsets in text_slices(chunk.table["text"]):
        starts, ends, first_word = word_bounds(data, offsets)
        gone = removed[seen : seen + len(starts)]
        seen += len(starts)
        cut = [] if join_words else [data[offsets[r] : offsets[r + 1]].tobytes() for r in range(end - begin)]
        for r in np.flatnonzero(n_removed[begin:end]):
            mask = gone[first_word[r] : first_word[r + 1]].astype(np.int8)
            turns = np.flatnonzero(np.diff(np.concatenate([[0], mask, [0]]))).reshape(-1, 2)
            span_rows[begin + r] = [{"first": int(a), "words": int(b - a)} for a, b in turns]
            if not join_words:
                edges = np.append(starts[first_word[r] : first_word[r + 1]], offsets[r + 1])
                bounds = [offsets[r], *edges[turns].ravel(), offsets[r + 1]]
                cut[r] = b"".join(data[a:b].tobytes() for a, b in zip(bounds[::2], bounds[1::2], strict=True))
        if join_words:
            row = np.repeat(np.arange(end - begin), np.diff(first_word))
            texts.append(_joined_words(data, starts[~gone], ends[~gone], row[~gone], end - begin))
        else:
            texts.append(pa.array(cut, pa.large_binary()).cast(pa.large_string()))
    out = chunk.table.select(["id", "rest"])
    out = out.append_column("text", pa.chunked_array(texts).cast(pa.string()) if texts else pa.array([], pa.string()))
    out = out.append_column("n_words", pa.array(np.diff(chunk.first_word), pa.int64()))
    out = out.append_column("n_removed", pa.array(n_removed, pa.int64()))
    spans = pa.list_(pa.struct([("first", pa.int64()), ("words", pa.int64())]))
    out = out.append_column("removed_spans", pa.array(span_rows, spans))
    if not join_words:
        was_null = chunk.table["text"].is_null()
        out = out.set_column(2, "text", pc.if_else(was_null, pa.scalar(None, pa.string()), out["text"].combine_chunks()))
    return out.cast(schema)


def repeated_passages(
    docs: DataFrame,
    length: int,
    anchors_of: AnchorsOf,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    join_words: bool = False,
    chunk_bytes: int = 4 << 20,
) -> DataFrame:
    """``docs`` without the words that windows of ``length`` words repeat; windows are judged on the input.

    The text column keeps its spacing around what is left or, with ``join_words``, holds the words left joined by
    one space (empty for a null text).  Adds ``n_words``, ``n_removed`` and ``removed_spans`` (first word and
    number of words of each run removed); input columns of these names are dropped.
    """
    size = docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0
    chunks = max(8, math.ceil(size / chunk_bytes))
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(chunks / 4))
    added = {"n_words", "n_removed", "removed_spans"}
    others = [c for c in docs.columns if c not in (id_col, text_col) and c not in added]
    dealt = docs.select(
        F.pmod(F.xxhash64(F.col(id_col).cast("long")), F.lit(chunks)).cast("int").alias("chunk"),
        F.col(id_col).cast("long").alias("id"),
        F.col(text_col).alias("text"),
        F.struct(*[F.col(f"`{c}`") for c in others], F.lit(True).alias("__row")).alias("rest"),
    ).repartition(parts, "chunk")
    how = {"length": length, "anchors_of": anchors_of, "buckets": chunks}
    schema = StructType(
        [dealt.schema["id"], dealt.schema["rest"], dealt.schema["text"]]
        + StructType.fromDDL("n_words long, n_removed long, removed_spans array<struct<first:long,words:long>>").fields
    )
    arrow = to_arrow_schema(schema)

    def anchors_out(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        try:
            return send_anchors(key[0].as_py(), table, **how)
        finally:
            give_back()

    def windows_out(key: tuple[pa.Scalar, ...], table: pa.Table, answers: pa.Table) -> pa.Table:
        try:
            return send_windows(key[0].as_py(), table, answers, **how)
        finally:
            give_back()

    def finish(table: pa.Table, answers: pa.Table) -> pa.Table:
        try:
            return remove_repeats(table, answers, **how, join_words=join_words, schema=arrow)
        finally:
            give_back()

    by_chunk = dealt.groupBy("chunk")
    shared = by_chunk.applyInArrow(anchors_out, RUNS).groupBy("bucket").applyInArrow(compare_anchors, ANSWERS)
    found = by_chunk.cogroup(shared.groupBy("chunk")).applyInArrow(windows_out, RUNS)
    later = found.groupBy("bucket").applyInArrow(compare_windows, ANSWERS)
    done = by_chunk.cogroup(shared.unionByName(later).groupBy("chunk")).applyInArrow(finish, schema)
    columns = [
        F.col("id").cast(docs.schema[id_col].dataType).alias(c) if c == id_col
        else F.col("text").alias(c) if c == text_col
        else F.col(f"rest.`{c}`").alias(c)
        for c in docs.columns if c not in added
    ]
    return done.select(*columns, "n_words", "n_removed", "removed_spans")


def substring_dedup(docs: DataFrame, length: int = 20, **options) -> DataFrame:
    """Difference-cover substring dedup; see ``repeated_passages``."""
    return repeated_passages(docs, length, cover_anchors, **options)


def suffix_dedup(docs: DataFrame, length: int = 50, **options) -> DataFrame:
    """Sparse-suffix-array dedup of passages of at least ``length`` words; see ``repeated_passages``."""
    return repeated_passages(docs, length, minimiser_anchors, **options)
