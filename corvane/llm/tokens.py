"""Token ids of whole texts by a tokenizer file of the ``tokenizers`` library, each distinct unit encoded once.

A text is cut into units before every run of ASCII white space that follows a character which is surely not white
space.  The file's byte-level split never crosses such a place, so the ids of a text are those of its units in
order.  Natural text repeats its units, so a task encodes what it has not met and gathers the rest with numpy.
Strings of special tokens in a text become their ids, as the library's plain call gives them; ``share`` can have them
spelt out as ordinary text.  The tokenizer's text travels as a broadcast: a public
file of a few MB, whatever the data.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import SparkSession

from corvane.llm.wordhash import SEPARATOR, text_slices, word_hashes

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

JOINED = 64  # units encoded as one string
MOST_UNITS = 500_000  # of the memory of distinct units (about 14 MB); beyond that only the half met most often stays
UNSURE_ASCII = np.zeros(256, dtype=bool)
UNSURE_ASCII[[0x20, *range(0x00, 0x20), 0x7F]] = True


class Encoder:
    def __init__(self, text: str, spell_specials: bool = False) -> None:
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_str(text)
        self._tokenizer.encode_special_tokens = spell_specials
        if not spell_specials and any(SEPARATOR[list(x.content.encode())].any() for x in self._tokenizer.get_added_tokens_decoder().values()):
            raise ValueError("a special token holds white space; units could cut it")
        size = self._tokenizer.get_vocab_size()
        if size > 1 << 16:
            raise ValueError("ids are kept in 16 bits")
        self._bytes = np.array([len(self._tokenizer.id_to_token(i)) for i in range(size)], dtype=np.int64)
        self._forget()

    def _forget(self) -> None:
        self._keys = np.zeros(0, dtype=np.uint64)  # sorted hashes of known units
        self._slots = np.zeros(0, dtype=np.int32)
        self._first = np.zeros(0, dtype=np.int32)
        self._length = np.zeros(0, dtype=np.int32)
        self._met = np.zeros(0, dtype=np.int32)  # slices that held the unit, halved at every clearing
        self._ids = np.zeros(0, dtype=np.uint16)

    def _keep_frequent(self) -> None:
        """Forget the units met least often, at least half of them."""
        held = np.argsort(-self._met, kind="stable")[: MOST_UNITS // 2]
        held = np.sort(held[self._met[held] > 1])
        stays = np.zeros(len(self._met), dtype=bool)
        stays[held] = True
        lengths = self._length[held]
        ends = np.cumsum(lengths)
        self._ids = self._ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self._first[held] - (ends - lengths), lengths)]
        self._first, self._length, self._met = (ends - lengths).astype(np.int32), lengths, self._met[held] // 2
        known = stays[self._slots]
        self._keys, self._slots = self._keys[known], (np.cumsum(stays, dtype=np.int32) - 1)[self._slots[known]]

    def encode(self, column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first row, row after the last, ids, row offsets into them); a null text has no ids."""
        for first, last, data, offsets in text_slices(column, 1 << 20):
            starts, row_units = unit_starts(data, offsets)
            ends = np.append(starts[1:], len(data)) if len(starts) else starts
            slots = self._slots_of(data, starts, ends)
            lengths = self._length[slots]
            out = np.concatenate([[0], np.cumsum(lengths)])
            ids = self._ids[np.arange(out[-1]) + np.repeat(self._first[slots] - out[:-1], lengths)]
            yield first, last, ids, out[row_units]

    def _slots_of(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        codes, distinct = pd.factorize(word_hashes(data, starts, ends))
        if not len(distinct):
            return np.zeros(0, dtype=np.int32)
        if len(self._keys) + len(distinct) > MOST_UNITS:
            self._keep_frequent()
        place = np.minimum(np.searchsorted(self._keys, distinct), max(len(self._keys) - 1, 0))
        known = self._keys[place] == distinct if len(self._keys) else np.zeros(len(distinct), dtype=bool)
        if not known.all():
            new = np.flatnonzero(~known)
            at = np.full(len(distinct), -1)
            at[codes[::-1]] = np.arange(len(codes))[::-1]  # where each distinct unit stands first
            self._learn(data, starts[at[new]], ends[at[new]], distinct[new])
            place = np.searchsorted(self._keys, distinct)
        slots = self._slots[place]
        self._met[slots] += 1
        return slots[codes]

    def _learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> None:
        regular = SEPARATOR[data[starts]] & sure_before(data, ends)
        order = np.concatenate([np.flatnonzero(regular), np.flatnonzero(~regular)])
        starts, ends, hashes = starts[order], ends[order], hashes[order]
        whole = data.tobytes()
        units = [whole[a:b].decode("utf-8", "replace") for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        n = int(regular.sum())
        texts = ["".join(units[i : min(i + JOINED, n)]) for i in range(0, n, JOINED)] + units[n:]
        found = [np.array(x.ids, dtype=np.uint16) for x in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        ids = np.concatenate(found)
        # a unit's ids end where the bytes of the ids do
        spelt = np.concatenate([[0], np.cumsum(self._bytes[ids])])
        edges = np.searchsorted(spelt, np.concatenate([[0], np.cumsum(ends - starts)]))
        slots = np.arange(len(hashes), dtype=np.int32) + np.int32(len(self._first))
        self._first = np.concatenate([self._first, (edges[:-1] + len(self._ids)).astype(np.int32)])
        self._length = np.concatenate([self._length, np.diff(edges).astype(np.int32)])
        self._met = np.concatenate([self._met, np.zeros(len(hashes), dtype=np.int32)])
        self._ids = np.concatenate([self._ids, ids])
        order = np.argsort(hashes)
        at = np.searchsorted(self._keys, hashes[order])
        self._keys, self._slots = np.insert(self._keys, at, hashes[order]), np.insert(self._slots, at, slots[order])


def sure_before(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character before each byte position is surely not white space.

    White space outside ASCII starts with 0xC2 (two bytes) or 0xE1 to 0xE3 (three); all such characters count as unsure.
    """
    back = lambda n: data[np.maximum(at - n, 0)]
    unsure = UNSURE_ASCII[back(1)] | ((back(2) == 0xC2) & (back(1) >= 0x80))
    return (at > 0) & ~unsure & ~((back(3) >= 0xE1) & (back(3) <= 0xE3) & (back(1) >= 0x80))


def unit_starts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts of the units, and the number of the first unit of each row (one more at the end)."""
    space = SEPARATOR[data]
    begins = np.zeros(len(data), dtype=bool)
    begins[1:] = space[1:] & ~space[:-1]
    at = np.flatnonzero(begins)
    begins[at[~sure_before(data, at)]] = False
    begins[offsets[:-1][np.diff(offsets) > 0]] = True
    starts = np.flatnonzero(begins)
    return starts, np.searchsorted(starts, offsets)


_encoder: tuple[str, Encoder] | None = None


def share(spark: SparkSession, path: str, spell_specials: bool = False) -> Broadcast:
    """The tokenizer's file for the tasks of one run."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast((uuid.uuid4().hex, f.read(), spell_specials))


def encoder(shared: Broadcast) -> Encoder:
    """This worker's encoder; what it has learnt is kept for the tasks of one run."""
    global _encoder
    run, text, spell_specials = shared.value
    if _encoder is None or _encoder[0] != run:
        _encoder = None  # the earlier one goes first
        _encoder = (run, Encoder(text, spell_specials))
    return _encoder[1]


def vocabulary_size(path: str) -> int:
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    return 1 + max([*file["model"]["vocab"].values(), *(x["id"] for x in file.get("added_tokens", []))])
