"""SentencePiece encoding and decoding with merge-type (BPE) vocabularies.

A text is normalised by the model's own rules and cut before every white-space mark that follows another character.
No piece of a merge-type vocabulary holds such a place (checked when the model is loaded), so no merge crosses it, and
the ids of a text are those of its units in order.  A unit is encoded by a score-ordered agenda: all adjacent symbol
pairs that form a piece wait in a heap, best score first and leftmost among equals; the best pair whose two symbols
still stand is merged, and the pairs that this makes are added.  Symbols that are no piece become their bytes.

Natural text repeats its units, so a worker keeps what it has met, up to ``MOST_CHARS`` characters in each of two
generations; when the young one is full it becomes the old one, and what was not asked for since is forgotten.  The
units of an Arrow batch that a worker has not met are also encoded and decoded by the ``sentencepiece`` library, and a
difference ends the job; the ids of whole texts are decoded by the library.

Defined cases: a null text is an empty one and has no ids; rows with the same or a null id are separate rows; a text
of any length is one text; other columns play no part; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import re
import sys
import uuid
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, functions as F

MARK = "▁"  # stands for white space in pieces
UNIT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
MOST_CHARS = 6_000_000
SHORT = (6, 12, 24, 48)  # symbols of a unit up to which units are merged side by side
NONE = 1 << 30
SLOT_BITS = 20  # of the table of pairs: 4 MB
SLICE_CHARS = 1 << 20  # texts handed to the library at once
ENCODED = "doc_id long, n_tokens long, ids array<int>, decoded string"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class Vocabulary:
    """Pieces and scores of a model, and the agenda over them."""

    def __init__(self, model: bytes) -> None:
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        plain = lambda i: not (self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_byte(i))
        self.ids = {name: i for i, name in enumerate(names) if plain(i)}
        self.bytes = {int(name[3:5], 16): i for i, name in enumerate(names) if self.library.is_byte(i)}
        self.unknown = self.library.unk_id()
        if any(re.search(f"[^{MARK}]{MARK}", name) for name in self.ids):
            raise ValueError("a piece holds white space after another character; units cannot be cut there")
        self.has_prefix = self.library.normalize("a") == MARK + "a"
        self._other = len(names)  # a character that is no piece is this number plus its code
        self._symbols = self._other + np.arange(sys.maxunicode + 1, dtype=np.int32)
        for name, i in self.ids.items():
            if len(name) == 1:
                self._symbols[ord(name)] = i
        symbol = lambda x: int(self._symbols[ord(x)]) if len(x) == 1 else self.ids.get(x)
        order = {score: rank for rank, score in enumerate(sorted({self.library.get_score(i) for i in self.ids.values()}, reverse=True))}
        pairs: dict[int, tuple[int, int]] = {}  # two symbols in one number: rank (best score first) and piece that they form
        for name, i in self.ids.items():
            for at in range(1, len(name)):
                left, right = symbol(name[:at]), symbol(name[at:])
                if left is not None and right is not None:
                    pairs[left << 21 | right] = (order[self.library.get_score(i)], i)
        self._pairs = pairs
        self._keys = np.array([*sorted(pairs), -1], dtype=np.int64)
        slots = slots_of(self._keys[:-1])
        self._table = np.full(1 << SLOT_BITS, len(pairs), dtype=np.int32)
        self._table[slots] = np.arange(len(pairs))
        lost = np.flatnonzero(self._table[slots] != np.arange(len(pairs)))
        self._shared, self._shared_at = self._keys[lost], lost.astype(np.int32)
        self._key_ranks = np.array([*(pairs[k][0] for k in sorted(pairs)), NONE], dtype=np.int32)
        self._key_pieces = np.array([*(pairs[k][1] for k in sorted(pairs)), -1], dtype=np.int32)
        value = {i: bytes([b]) for b, i in self.bytes.items()}
        text = lambda i: " ⁇ " if i == self.unknown else names[i].replace(MARK, " ") if plain(i) else ""
        self._spellings = [value.get(i) or text(i).encode("utf-8") for i in range(len(names))]
        self._is_byte = [i in value for i in range(len(names))]
        self._starts_with_space = [plain(i) and name.startswith(MARK) for i, name in enumerate(names)]
        self.decimals = [str(i) for i in range(len(names))]
        self._young: dict[str, tuple[int, ...]] = {}
        self._old: dict[str, tuple[int, ...]] = {}
        self._room = MOST_CHARS

    def merge(self, units: list[str]) -> list[tuple[int, ...]]:
        """The ids of each unit by the agenda."""
        out: list[tuple[int, ...]] = [()] * len(units)
        sizes = np.fromiter(map(len, units), dtype=np.int64, count=len(units))
        low = 0
        for high in SHORT:
            rows = np.flatnonzero((sizes > low) & (sizes <= high))
            for part in np.array_split(rows, len(rows) // 20_000 + 1):
                found = self._merge_short([units[i] for i in part], sizes[part])
                for i, ids in zip(part.tolist(), found, strict=True):
                    out[i] = ids
            low = high
        for i in np.flatnonzero(sizes > low).tolist():
            out[i] = tuple(self._merge_long(self._symbols[codes(units[i])].tolist()))
        return [ids if max(ids) < self._other else self._spelt(ids) for ids in out]

    def _spelt(self, symbols: tuple[int, ...]) -> tuple[int, ...]:
        """Symbols that are no piece as their bytes, or as the unknown id."""
        ids: list[int] = []
        for symbol in symbols:
            if symbol < self._other:
                ids.append(symbol)
            elif self.bytes:
                ids.extend(self.bytes[b] for b in chr(symbol - self._other).encode("utf-8"))
            elif not ids or ids[-1] != self.unknown:
                ids.append(self.unknown)
        return tuple(ids)

    def _places(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Where each pair stands in the table of pairs; its last row is for those that form no piece."""
        keys = left.astype(np.int64) << 21 | right
        at = self._table[slots_of(keys)]
        other = np.flatnonzero(self._keys[at] != keys)
        at[other] = len(self._keys) - 1
        if len(self._shared):  # pairs whose slot another pair has
            near = np.minimum(np.searchsorted(self._shared, keys[other]), len(self._shared) - 1)
            found = self._shared[near] == keys[other]
            at[other[found]] = self._shared_at[near[found]]
        return at

    def _merge_short(self, units: list[str], sizes: np.ndarray) -> list[tuple[int, ...]]:
        """Many units side by side: a row holds the agenda of a unit, one rank a place; every round merges the best
        pair of each row, the leftmost among equals.  The places of a row that still stand are linked both ways."""
        if not units:
            return []
        width = int(sizes.max())
        inside = np.arange(width) < sizes[:, None]
        symbols = np.full((len(units), width), -1, dtype=np.int32)
        symbols[inside] = self._symbols[codes("".join(units))]
        after = np.where(np.arange(1, width + 1) < sizes[:, None], np.arange(1, width + 1), -1).astype(np.int16)
        before = np.broadcast_to(np.arange(-1, width - 1, dtype=np.int16), symbols.shape).copy()
        agenda = np.full(symbols.shape, NONE, dtype=np.int32)
        pairs = inside[:, 1:]
        agenda[:, :-1][pairs] = self._key_ranks[self._places(symbols[:, :-1][pairs], symbols[:, 1:][pairs])]
        rows = np.arange(len(units))
        while True:
            best = agenda[rows].argmin(axis=1)
            still = agenda[rows, best] < NONE
            rows, best = rows[still], best[still]
            if not len(rows):
                break
            right = after[rows, best]
            behind = after[rows, right]
            symbols[rows, best] = self._key_pieces[self._places(symbols[rows, best], symbols[rows, right])]
            symbols[rows, right] = -1
            agenda[rows, right] = agenda[rows, best] = NONE
            after[rows, best] = behind
            some = behind >= 0
            before[rows[some], behind[some]] = best[some]
            agenda[rows[some], best[some]] = self._key_ranks[self._places(symbols[rows[some], best[some]], symbols[rows[some], behind[some]])]
            ahead = before[rows, best]
            some = ahead >= 0
            agenda[rows[some], ahead[some]] = self._key_ranks[self._places(symbols[rows[some], ahead[some]], symbols[rows[some], best[some]])]
        stands = symbols >= 0
        ids, edges = symbols[stands].tolist(), [0, *np.cumsum(stands.sum(axis=1)).tolist()]
        return [tuple(ids[a:b]) for a, b in zip(edges, edges[1:])]  # noqa: B905

    def _merge_long(self, symbols: list[int]) -> list[int]:
        """The agenda as a heap of (rank, left place) in one number; an entry that no longer holds is passed over."""
        pairs, nothing = self._pairs.get, (None, None)
        n = len(symbols)
        before, after, width = list(range(-1, n - 1)), [*range(1, n), -1], n.bit_length()
        both = enumerate(zip(symbols, symbols[1:]))  # noqa: B905
        agenda = [pair[0] << width | i for i, (a, b) in both if (pair := pairs(a << 21 | b))]
        heapify(agenda)
        while agenda:
            rank, left = divmod(heappop(agenda), 1 << width)
            right = after[left]
            if symbols[left] < 0 or right < 0:
                continue
            now, piece = pairs(symbols[left] << 21 | symbols[right], nothing)
            if now != rank:
                continue
            symbols[left] = piece
            symbols[right] = -1
            after[left] = after[right]
            if after[left] >= 0:
                before[after[left]] = left
            for at in (left, before[left]):
                if at >= 0 and after[at] >= 0:
                    pair = pairs(symbols[at] << 21 | symbols[after[at]])
                    if pair:
                        heappush(agenda, pair[0] << width | at)
        return [x for x in symbols if x >= 0]

    def encode(self, normalised: list[str]) -> Iterator[list[int]]:
        """The ids of each text; a unit is merged where this worker has not met it."""
        texts = [UNIT.findall(text) for text in normalised]
        new = set(chain.from_iterable(texts)).difference(self._young)
        for unit in new.intersection(self._old):
            self._young[unit] = self._old[unit]
        unknown = list(new.difference(self._old))
        merged = self.merge(unknown)
        self._check(unknown, merged)
        self._young.update(zip(unknown, merged, strict=True))
        known = self._young
        self._room -= sum(map(len, new))
        if self._room < 0:
            self._old, self._young, self._room = self._young, {}, MOST_CHARS
        for units in texts:
            yield list(chain.from_iterable(map(known.__getitem__, units)))

    def _check(self, units: list[str], merged: list[tuple[int, ...]]) -> None:
        """Units against the library, which itself puts a mark before a text where the model says so.

        Every unit starts with a mark then, as the first one of a text does.
        """
        texts = [unit.removeprefix(MARK) for unit in units] if self.has_prefix else units
        for text, theirs, ours in zip(texts, self.library.encode(texts, num_threads=1), merged, strict=True):
            # a text without characters has no ids, though the unit of a mark alone has one
            if text and tuple(theirs) != ours:
                raise ValueError("the agenda and the sentencepiece library differ; is the model of the merge type?")
        together = list(chain.from_iterable(merged))
        if self.decode(together) != self.library.decode(together):
            raise ValueError("decoding and the sentencepiece library differ")

    def decode(self, ids: list[int]) -> str:
        try:
            text = b"".join(map(self._spellings.__getitem__, ids)).decode("utf-8")
        except UnicodeDecodeError:  # bytes that are no characters
            runs = groupby(ids, self._is_byte.__getitem__)
            text = "".join(characters(b"".join(map(self._spellings.__getitem__, run))) for _, run in runs)
        return text[1:] if self.has_prefix and ids and self._starts_with_space[ids[0]] else text


def slots_of(keys: np.ndarray) -> np.ndarray:
    return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOT_BITS)


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)


def characters(run: bytes) -> str:
    """UTF-8 characters of byte pieces; every byte that starts none is a replacement character."""
    try:
        return run.decode("utf-8")
    except UnicodeDecodeError:
        pass
    out, at = [], 0
    while at < len(run):
        for n in (1, 2, 3, 4):
            try:
                out.append(run[at : at + n].decode("utf-8"))
                at += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


_vocabulary: tuple[str, Vocabulary] | None = None


def share(spark: SparkSession, path: str) -> Broadcast:
    """The model's file (a few MB, whatever the data) for the tasks of one run."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast((uuid.uuid4().hex, f.read()))


def vocabulary(shared: Broadcast) -> Vocabulary:
    global _vocabulary
    run, model = shared.value
    if _vocabulary is None or _vocabulary[0] != run:
        _vocabulary = (run, Vocabulary(model))
    return _vocabulary[1]


def coded(words: Vocabulary, texts: list[str]) -> Iterator[tuple[list[int], str]]:
    """(ids, decoded text) of every text; whole texts are decoded by the library."""
    for ids in words.encode(words.library.normalize(texts)):
        yield ids, words.library.decode(ids)


def slices(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of runs of rows of about ``SLICE_CHARS`` characters."""
    first, texts, chars = 0, [], 0
    for row in range(len(column)):
        text = column[row].as_py() or ""
        texts.append(text)
        chars += len(text)
        if chars >= SLICE_CHARS:
            yield first, texts
            first, texts, chars = row + 1, [], 0
    if texts:
        yield first, texts


def encode_decode(
    docs: DataFrame, model: str, *, id_col: str = "doc_id", text_col: str = "text", digests: bool = False
) -> DataFrame:
    """Per row its id, the number of ids, the ids and the text decoded from them.

    With ``digests``, the SHA-256 of the decimal ids joined by commas and of the decoded text stand in place of both.
    """
    shared = share(docs.sparkSession, model)
    sha = lambda text: hashlib.sha256(text.encode("utf-8")).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(shared)
        for batch in batches:
            for first, texts in slices(batch.column(1)):
                counts, ids, decoded = [], [], []
                for own, text in coded(words, texts):
                    counts.append(len(own))
                    ids.append(sha(",".join(map(words.decimals.__getitem__, own))) if digests else own)
                    decoded.append(sha(text) if digests else text)
                columns = [
                    batch.column(0).slice(first, len(texts)), pa.array(counts, pa.int64()),
                    pa.array(ids, pa.string() if digests else pa.list_(pa.int32())), pa.array(decoded, pa.string()),
                ]
                names = [x.split()[0] for x in (DIGESTS if digests else ENCODED).split(", ")]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(run, DIGESTS if digests else ENCODED)
