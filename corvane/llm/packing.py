"""Packing documents into training sequences by bounded-space best fit.

Every partition keeps a fixed number of open windows.  A document's full windows stand alone; its rest goes into
the open window that it fills best.  When none fits and all windows are open, the fullest one is emitted,
topped up with a cut of the piece if it has room for ``least_cut`` tokens or more.  When a partition ends, its open windows are merged into full ones by cutting, and the one that is left over is merged with
those of other partitions, sixteen at a time, until one group is left.

Defined cases: a null text is empty and still yields its end id; rows with the same or a null id are packed like
any other; other columns play no part; an empty table gives an empty table.
"""

from __future__ import annotations

import bisect
import itertools
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from corvane.lineage import cut
from corvane.llm import tokens
from corvane.llm.memory import lean

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "ids binary, is_window boolean"
)
MERGED = "window long, sequence_id long, shift long, fill long, team long, is_open boolean"


class Piece(NamedTuple):
    doc_id: int | None
    start: int
    ids: bytes  # little-endian unsigned 32-bit
    doc_tokens: int

    @property
    def size(self) -> int:
        return len(self.ids) // 4

    def cut_at(self, n: int) -> tuple[Piece, Piece]:
        return self._replace(ids=self.ids[: 4 * n]), self._replace(start=self.start + n, ids=self.ids[4 * n :])


class OpenWindows:
    """At most ``most`` windows with room, found by the room they have; closed ones are handed to ``emit``."""

    def __init__(self, capacity: int, most: int, least_cut: int, emit: Callable[[list[Piece], bool], None]) -> None:
        self.capacity, self.most, self.least_cut, self._emit = capacity, most, least_cut, emit
        self._rooms: list[tuple[int, int]] = []  # (room, window), sorted
        self._pieces: dict[int, list[Piece]] = {}
        self._next = 0

    def place(self, piece: Piece) -> None:
        at = bisect.bisect_left(self._rooms, (piece.size, -1))
        if at < len(self._rooms):
            room, window = self._rooms.pop(at)
        else:
            if len(self._rooms) >= self.most:
                room, window = self._rooms.pop(0)  # the fullest
                if room >= self.least_cut:
                    piece, rest = piece.cut_at(room)
                    self._emit([*self._pieces.pop(window), piece], False)
                    return self.place(rest)
                self._emit(self._pieces.pop(window), False)
            room, window = self.capacity, self._next
            self._pieces[window] = []
            self._next += 1
        self._pieces[window].append(piece)
        if room > piece.size:
            bisect.insort(self._rooms, (room - piece.size, window))
        else:
            self._emit(self._pieces.pop(window), False)

    def close(self) -> None:
        """Fill the fuller windows with cut pieces of the emptier ones; only the last one stays open."""
        windows = [self._pieces.pop(window) for _, window in self._rooms]
        loose: list[Piece] = []
        while windows or loose:
            window = windows.pop(0) if windows else []
            room = self.capacity - sum(p.size for p in window)
            while room and (windows or loose):
                if not loose:
                    loose = windows.pop()
                piece = loose.pop()
                if piece.size > room:
                    piece, rest = piece.cut_at(room)
                    loose.append(rest)
                window.append(piece)
                room -= piece.size
            self._emit(window, room > 0)


def merge_windows(rows: list[tuple[int, int, int, int]], capacity: int, most: int) -> list[tuple[int, int, int, int, bool]]:
    """Pack whole windows into each other, the fullest first.

    Takes and returns (first window, window it lies in, shift there, fill of that), returned with whether that one
    may still take more; of these the ``most`` emptiest stay open.
    """
    fill = {now: full for _, now, _, full in rows}
    target: dict[int, tuple[int, int]] = {}
    rooms: list[tuple[int, int]] = []
    for now, full in sorted(fill.items(), key=lambda x: (-x[1], x[0])):
        at = bisect.bisect_left(rooms, (full, -1))
        if at < len(rooms):
            room, into = rooms.pop(at)
            target[now] = (into, capacity - room)
            room -= full
        else:
            target[now], into, room = (now, 0), now, capacity - full
        fill[into] = capacity - room
        if room:
            bisect.insort(rooms, (room, into))
    still = {window for _, window in rooms[-most:]}
    return [
        (w, target[now][0], shift + target[now][1], fill[target[now][0]], target[now][0] in still)
        for w, now, shift, _ in rows
    ]


def pack(
    docs: DataFrame,
    tokenizer: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 1024,
    end_id: int = 0,
    open_windows: int = 256,
    least_cut: int = 16,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: where it starts in its document, its sequence and the offset there.

    ``with_ids`` adds the ids as little-endian unsigned 32-bit integers.
    """
    shared = tokens.share(docs.sparkSession, tokenizer)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(shared)
        numbers = itertools.count(TaskContext.get().partitionId() << 40)
        rows: list[tuple] = []

        def emit(window: list[Piece], is_open: bool) -> None:
            number, offset = next(numbers), 0
            for p in window:
                rows.append((p.doc_id, p.start, p.size, zlib.crc32(p.ids), p.doc_tokens, number, offset, p.ids if with_ids else None, False))
                offset += p.size
            if is_open:
                rows.append((None, None, offset, None, None, number, None, None, True))

        windows = OpenWindows(capacity, open_windows, least_cut, emit)
        for batch in batches:
            for first, last, ids, offsets in encoder.encode(batch.column(1)):
                for row, name in enumerate(batch.column(0).slice(first, last - first).to_pylist()):
                    own = np.append(ids[offsets[row] : offsets[row + 1]], np.uint32(end_id)).astype("<u4")
                    for start in range(0, len(own), capacity):
                        windows.place(Piece(name, start, own[start : start + capacity].tobytes(), len(own)))
                if rows:
                    yield batch_of(rows)
                    rows.clear()
        windows.close()
        yield batch_of(rows)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [()] * 9
        types = [pa.int64()] * 7 + [pa.binary(), pa.bool_()]
        arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=names_of(PIECES))

    def names_of(ddl: str) -> list[str]:
        return [x.split()[0] for x in ddl.split(",")]

    def merge(table: pa.Table) -> pa.Table:
        columns = [table[c].to_pylist() for c in ("window", "sequence_id", "shift", "fill")]
        merged = merge_windows(sorted(zip(*columns, strict=True)), capacity, open_windows)
        team = table["team"][0].as_py()
        rows = list(zip(*[(*x[:4], team, x[4]) for x in merged], strict=True))
        types = [pa.int64()] * 5 + [pa.bool_()]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(rows, types, strict=True)], names=names_of(MERGED))

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    placed = cut(texts.mapInArrow(lean(pieces), PIECES), "pieces")
    left = placed.where("is_window").select(
        F.col("sequence_id").alias("window"), "sequence_id", F.lit(0).cast("long").alias("shift"),
        F.col("length").alias("fill"), F.shiftright("sequence_id", 40).alias("team"), F.lit(True).alias("is_open"),
    )
    settled = None
    while True:
        left = left.withColumn("team", F.floor(F.col("team") / 16))
        done = cut(left.groupBy("team").applyInArrow(merge, MERGED), "windows")
        last = (done.agg(F.max("team")).first()[0] or 0) == 0
        closed = done if last else done.where(~F.col("is_open"))
        settled = closed if settled is None else settled.unionByName(closed)
        if last:
            break
        left = done.where("is_open")
    moved = settled.select("window", F.col("sequence_id").alias("into"), "shift")
    rows = placed.where(~F.col("is_window")).join(moved, F.col("sequence_id") == F.col("window"), "left")
    return rows.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        F.coalesce("into", "sequence_id").alias("sequence_id"),
        (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"),
        *(["ids"] if with_ids else []),
    )
