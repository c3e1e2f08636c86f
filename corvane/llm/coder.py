"""Token ids in blocks, compressed by a context-mixing range coder, and read back.

A block holds whole documents and is coded on its own: models start afresh and its ids and bytes carry checksums.  The
ids of a block are laid out in lanes that advance together, one id of each lane a step, so numpy codes a step of
all lanes at once while every lane has its own range coder.  For each id, order 2 (the two ids before) and order 1
(the one before) predict an id each; the counts for their joint confidence mix into one distribution over "as order 2
says", "as order 1 says" and "neither", and in the last case the id follows with its order-0 frequency in the
block so far.  All arithmetic is on integers, so every machine decodes what any machine wrote.

A file is a Parquet file of block records (``shard``, ``block``, ``n_ids``, ``record``); records are read
independently, and shards ascend with the document id.  A record is a header, the ids and lengths of its documents, the
lengths of the lanes' codes and the codes.

Defined cases: a null or empty text has the end id alone; documents with the same id follow each other in the order of
their texts; a row without an id comes first; a document longer than a block is a block of its own; other columns
play no part; an empty table gives an empty folder of files and an empty table.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from corvane.llm import tokens

MAGIC = b"CVTB"
HEADER = struct.Struct("<4sIIIIII")  # magic, ids, documents, lanes, vocabulary, crc32 of the ids, crc32 of the rest
BLOCK_IDS, LANES, STEP = 1 << 21, 4096, 64
U = np.uint64
WORD = U(1 << 48)
SCALE, SCALE_BITS = 4096, U(12)
RECORDS = "shard int, block int, n_ids long, record binary"
READ = "shard int, block int, doc_id long, local long, n_tokens long, ids_crc32 long"


class Model:
    """What a block has shown so far; the coder and the decoder make the same calls.

    A cell of orders 1 and 2 holds the id it expects, shifted by three bits, and how sure it is of it in these bits.
    """

    def __init__(self, vocabulary: int) -> None:
        self.count = np.ones(vocabulary, dtype=np.uint64)
        self.cells1, self.cells2 = np.zeros(vocabulary, dtype=np.int32), np.zeros(1 << 20, dtype=np.int32)
        self.seen = np.ones(384, dtype=np.int64)
        self.edges = np.zeros((128, 4), dtype=np.uint64)
        self.edges[:, 3] = SCALE
        self.steps, self.pending = 0, []
        self._rebuild()
        self._share()

    def _rebuild(self) -> None:
        if self.pending:
            self.count += np.bincount(np.concatenate(self.pending), minlength=len(self.count)).astype(np.uint64) * U(24)
        self.pending = []
        self.below = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.count)])
        self.total = self.below[-1]

    def count_at(self, ids: np.ndarray) -> np.ndarray:
        return self.below.take(ids + 1) - self.below.take(ids)

    def _share(self) -> None:
        seen = self.seen.reshape(128, 3)
        shares = 1 + seen[:, :2] * (SCALE - 3) // seen.sum(axis=1, keepdims=True)
        self.edges[:, 1:3] = np.cumsum(shares, axis=1)

    def predict(self, before2: np.ndarray, before1: np.ndarray) -> None:
        """The ids that orders 2 and 1 expect, and how the three outcomes share the scale."""
        self.at2 = ((before2 * 40503) ^ (before1 * 2654435761 >> 7)) & ((1 << 20) - 1)
        self.at1 = before1
        self.cell2, self.cell1 = self.cells2.take(self.at2), self.cells1.take(before1)
        self.id2, self.id1 = self.cell2 >> 3, self.cell1 >> 3
        self.context = ((self.cell2 & 7) << 3) + (self.cell1 & 7) + ((self.id1 == self.id2) * np.int32(64))

    def learn(self, ids: np.ndarray, outcome: np.ndarray, rare: np.ndarray) -> None:
        self.seen += np.bincount(self.context * 3 + outcome, minlength=384)
        anew = (ids << 3).astype(np.int32) + np.int32(1)
        for cells, at, cell, said in ((self.cells2, self.at2, self.cell2, self.id2), (self.cells1, self.at1, self.cell1, self.id1)):
            trust = cell & 7
            cells[at] = np.where(said == ids, cell + (trust < 7), np.where(trust > 1, cell - 1, anew))
        if len(rare):
            self.pending.append(ids[rare])
        self.steps += 1
        if self.steps % STEP == 0 or self.steps & (self.steps - 1) == 0:
            self._rebuild()
        if self.steps % 4 == 0 or self.steps < 16:
            self._share()


class Ranges:
    """The range coders of the lanes: 64-bit ranges, 16-bit words, no carries; sums wrap."""

    def __init__(self, lanes: int) -> None:
        self.low = np.zeros(lanes, dtype=np.uint64)
        self.range = np.full(lanes, ~U(0), dtype=np.uint64)

    def moves(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Lanes with a word to move, and that word, until every range is wide again."""
        at = np.flatnonzero(((self.low ^ (self.low + self.range)) < WORD) | (self.range < WORD))
        while len(at):
            low, width = self.low[at], self.range[at]
            width = np.where((low ^ (low + width)) < WORD, width, (~low + U(1)) & (WORD - U(1))) << U(16)
            yield at, low >> U(48)
            low = low << U(16)
            self.low[at], self.range[at] = low, width
            at = at[((low ^ (low + width)) < WORD) | (width < WORD)]


def _layout(n: int) -> tuple[int, int]:
    lanes = max(1, min(LANES, n // 256))
    return lanes, -(-n // lanes)


def encode_ids(ids: np.ndarray, vocabulary: int) -> tuple[int, np.ndarray, bytes]:
    """Lanes, the number of words of each, and their words one lane after the other."""
    n = len(ids)
    lanes, steps = _layout(n)
    grid = np.zeros(lanes * steps, dtype=np.int64)
    grid[:n] = ids
    grid = np.ascontiguousarray(grid.reshape(lanes, steps).T)
    model, coder = Model(vocabulary), Ranges(lanes)
    width = 3 * steps + 16
    out = np.zeros(lanes * width, dtype="<u2")
    first = np.arange(lanes) * width
    place = first.copy()

    before2 = before1 = np.zeros(lanes, dtype=np.int64)
    for now in grid:
        model.predict(before2, before1)
        outcome = np.where(now == model.id2, 0, np.where(now == model.id1, 1, 2))
        edge = model.context * 4 + outcome
        edges = model.edges.ravel()
        start = edges.take(edge)
        unit = coder.range >> SCALE_BITS
        coder.low += start * unit
        coder.range = (edges.take(edge + 1) - start) * unit
        rare = np.flatnonzero(outcome == 2)
        if len(rare):
            own = now[rare]
            unit = coder.range[rare] // model.total
            coder.low[rare] += model.below.take(own) * unit
            coder.range[rare] = model.count_at(own) * unit
        for at, word in coder.moves():
            out[place[at]] = word
            place[at] += 1
        model.learn(now, outcome, rare)
        before2, before1 = before1, now
    for shift in (48, 32, 16, 0):
        out[place] = (coder.low >> U(shift)) & U(0xFFFF)
        place += 1
    filled = place - first
    return lanes, filled, out.reshape(lanes, width)[np.arange(width) < filled[:, None]].tobytes()


def decode_ids(n: int, vocabulary: int, lanes: int, words: np.ndarray, code: bytes) -> np.ndarray:
    if not n:
        return np.zeros(0, dtype=np.int64)
    steps = -(-n // lanes)
    first = np.concatenate([[0], np.cumsum(words)])[:-1]
    data = np.concatenate([np.frombuffer(code, dtype="<u2"), np.zeros(4, dtype="<u2")]).astype(np.uint64)
    model, coder = Model(vocabulary), Ranges(lanes)
    value = np.zeros(lanes, dtype=np.uint64)
    for word in range(4):
        value = (value << U(16)) | data[first + word]
    place = first + 4
    grid = np.zeros((steps, lanes), dtype=np.int64)

    before2 = before1 = np.zeros(lanes, dtype=np.int64)
    for now in grid:
        model.predict(before2, before1)
        unit = coder.range >> SCALE_BITS
        inside = value - coder.low
        edges = model.edges.ravel()
        row = model.context * 4
        outcome = (inside >= edges.take(row + 1) * unit).astype(np.int32) + (inside >= edges.take(row + 2) * unit)
        now[:] = np.where(outcome == 0, model.id2, model.id1)
        edge = row + outcome
        start = edges.take(edge)
        coder.low += start * unit
        coder.range = (edges.take(edge + 1) - start) * unit
        rare = np.flatnonzero(outcome == 2)
        if len(rare):
            unit = coder.range[rare] // model.total
            share = (value[rare] - coder.low[rare]) // unit
            order = np.argsort(share)  # a search for ascending values runs through memory once
            own = np.empty(len(rare), dtype=np.int64)
            own[order] = np.searchsorted(model.below, share[order], side="right") - 1
            now[rare] = own
            coder.low[rare] += model.below.take(own) * unit
            coder.range[rare] = model.count_at(own) * unit
        for at, _ in coder.moves():
            value[at] = (value[at] << U(16)) | data[np.minimum(place[at], len(data) - 1)]
            place[at] += 1
        model.learn(now, outcome, rare)
        before2, before1 = before1, now
    return grid.T.ravel()[:n]


def write_record(names: list[int | None], sizes: list[int], ids: np.ndarray, vocabulary: int) -> bytes:
    lanes, words, code = encode_ids(ids, vocabulary)
    known = np.array([x is not None for x in names], dtype=np.uint8)
    rest = b"".join(
        [known.tobytes(), np.array([x or 0 for x in names], "<i8").tobytes(), np.array(sizes, "<u4").tobytes(), words.astype("<u4").tobytes(), code]
    )
    crc = zlib.crc32(ids.astype("<u4").tobytes())
    return HEADER.pack(MAGIC, len(ids), len(names), lanes, vocabulary, crc, zlib.crc32(rest)) + rest


def read_record(record: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, lengths and token ids; a damaged record raises an error."""
    magic, n, docs, lanes, vocabulary, crc, rest_crc = HEADER.unpack_from(record)
    rest = memoryview(record)[HEADER.size :]
    if magic != MAGIC or zlib.crc32(rest) != rest_crc:
        raise ValueError("damaged block: its bytes do not match their checksum")
    known = np.frombuffer(rest, np.uint8, docs, 0)
    names = np.frombuffer(rest, "<i8", docs, docs)
    sizes = np.frombuffer(rest, "<u4", docs, 9 * docs).astype(np.int64)
    words = np.frombuffer(rest, "<u4", lanes, 13 * docs).astype(np.int64)
    ids = decode_ids(n, vocabulary, lanes, words, bytes(rest[13 * docs + 4 * lanes :]))
    if zlib.crc32(ids.astype("<u4").tobytes()) != crc:
        raise ValueError("damaged block: its ids do not match their checksum")
    return [int(x) if k else None for x, k in zip(names, known, strict=True)], sizes, ids


def write_ids(docs: DataFrame, tokenizer: str, path: str, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2) -> None:
    """Write the ids of all texts, each with ``end_id``, in ascending order of the document id."""
    spark = docs.sparkSession
    shared, vocabulary = tokens.share(spark, tokenizer), tokens.vocabulary_size(tokenizer)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, block = tokens.encoder(shared), TaskContext.get().partitionId(), 0
        names, sizes, parts, held = [], [], [], 0
        for batch in batches:
            for first, last, ids, offsets in encoder.encode(batch.column(1)):
                every = batch.column(0).slice(first, last - first).to_pylist()
                for row, name in enumerate(every):
                    own = ids[offsets[row] : offsets[row + 1]]
                    if held and held + len(own) + 1 > BLOCK_IDS:
                        yield record(shard, block, names, sizes, parts)
                        block, names, sizes, parts, held = block + 1, [], [], [], 0
                    names.append(name)
                    sizes.append(len(own) + 1)
                    parts += [own, np.array([end_id], dtype=np.uint16)]
                    held += len(own) + 1
        if names:
            yield record(shard, block, names, sizes, parts)

    def record(shard: int, block: int, names: list, sizes: list, parts: list) -> pa.RecordBatch:
        ids = np.concatenate(parts).astype(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([len(ids)], pa.int64()), pa.array([write_record(names, sizes, ids, vocabulary)], pa.binary())],
            names=["shard", "block", "n_ids", "record"],
        )

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = texts.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(encode, RECORDS).write.option("compression", "none").parquet(path)


def read_ids(spark: SparkSession, path: str, *, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document in the files, and its ids if asked for."""
    schema = READ + (", ids array<int>" if with_ids else "")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, block, record in zip(batch["shard"], batch["block"], batch["record"], strict=True):
                names, sizes, ids = read_record(record.as_py())
                ends = np.cumsum(sizes)
                raw = ids.astype("<u4")
                crcs = [zlib.crc32(raw[e - s : e].tobytes()) for s, e in zip(sizes, ends, strict=True)]
                n = len(names)
                columns = [pa.array([shard.as_py()] * n, pa.int32()), pa.array([block.as_py()] * n, pa.int32())]
                columns += [pa.array(x, pa.int64()) for x in (names, ends - sizes, sizes, crcs)]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(ids, pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in schema.split(", ")])

    files = spark.read.schema(RECORDS).parquet(path)
    sizes = files.select("shard", "block", "n_ids")
    before = F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shards = sizes.groupBy("shard").agg(F.sum("n_ids").alias("n")).select("shard", before.alias("shard_start"))
    inside = F.coalesce(F.sum("n_ids").over(Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = sizes.select("shard", "block", inside.alias("block_start")).join(shards, "shard")
    found = files.select("shard", "block", "record").mapInArrow(decode, schema).join(blocks, ["shard", "block"])
    start = (F.col("shard_start") + F.col("block_start") + F.col("local")).alias("start")
    return found.select("doc_id", start, "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))
