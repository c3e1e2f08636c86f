"""Words, word hashes and hashes of word windows, computed on whole Arrow buffers with numpy.

A word is a longest run of bytes other than space and 0x09-0x0D.  A word's hash is a polynomial over
its bytes modulo 2**64, taken from one running sum over the buffer and then mixed; windows of words are
hashed the same way from a running sum over the words.  Windows that must be told apart exactly get a
second, independent 32 bits (``window_checks``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit values in which every input bit reaches every output bit."""
    h = h ^ U(seed)
    h ^= h >> U(30)
    h *= U(0xBF58476D1CE4E5B9)
    h ^= h >> U(27)
    h *= U(0x94D049BB133111EB)
    h ^= h >> U(31)
    return h


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * U(0x9E3779B97F4A7C15))


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand up to a kept length."""

    KEPT = 1 << 20

    def __init__(self, base: int) -> None:
        self._bases = (base, pow(base, -1, 1 << 64))
        self._tables = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]

    def up_to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._tables[0]) < n:
            size = max(n, min(2 * n, self.KEPT))
            tables = []
            for base, table in zip(self._bases, self._tables, strict=True):
                while len(table) < size:
                    step = U(pow(base, len(table), 1 << 64))
                    table = np.concatenate([table, table[: size - len(table)] * step])
                tables.append(table)
            if size > self.KEPT:
                return tables[0][:n], tables[1][:n]
            self._tables = tables
        return self._tables[0][:n], self._tables[1][:n]


BYTE_POWERS = Powers(0x2545F4914F6CDD1D)
WORD_POWERS = Powers(0xD1342543DE82EF95)
CHECK_POWERS = Powers(0xA0761D6478BD642F)


def text_slices(column: pa.Array | pa.ChunkedArray, most_bytes: int = 1 << 17) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, row offsets into them) for runs of rows of about ``most_bytes``.

    A null text has no bytes.  A row is never cut; a longer one is a slice of its own.
    """
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    before = 0
    for chunk in chunks:
        if not len(chunk):
            continue
        chunk = chunk.cast(pa.large_string())
        if chunk.null_count:
            chunk = chunk.fill_null("")
        _, offsets, data = chunk.buffers()
        offsets = np.frombuffer(offsets, dtype=np.int64)[chunk.offset : chunk.offset + len(chunk) + 1]
        data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
        first = 0
        while first < len(chunk):
            last = int(np.searchsorted(offsets, offsets[first] + most_bytes, side="right")) - 1
            last = min(len(chunk), max(last, first + 1))
            yield before + first, before + last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
            first = last
        before += len(chunk)


def word_bounds(
    data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SEPARATOR
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and the number of the first word of each row (one more at the end)."""
    gap = np.ones(len(data) + 2, dtype=bool)
    gap[1:-1] = separator[data]
    word = ~gap
    starts = word[1:-1] & gap[:-2]
    ends = word[1:-1] & gap[2:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    starts[inner] |= word[1:-1][inner]
    ends[inner - 1] |= word[1:-1][inner - 1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(starts, offsets, side="left")


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    powers, inverse = BYTE_POWERS.up_to(len(data))
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(BYTE_VALUES[data] * powers, out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts], 0x51ED270B)


def letter_runs() -> np.ndarray:
    """A separator table that keeps ASCII letters and digits and everything outside ASCII."""
    table = np.zeros(256, dtype=bool)
    table[:128] = True
    for low, high in ("09", "AZ", "az"):
        table[ord(low) : ord(high) + 1] = False
    return table


def _windows(hashes: np.ndarray, n: int, powers: Powers, seed: int) -> np.ndarray:
    if len(hashes) < n:
        return np.zeros(0, dtype=np.uint64)
    up, down = powers.up_to(len(hashes))
    total = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * up, out=total[1:])
    return mix((total[n:] - total[:-n]) * down[: len(hashes) - n + 1], seed + n)


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the words i .. i+n-1, for every i."""
    return _windows(hashes, n, WORD_POWERS, 0x1B873593)


def window_checks(hashes: np.ndarray, n: int) -> np.ndarray:
    """32 further bits for the same windows, from other powers over other word values."""
    return (_windows(mix(hashes, 0x2127599B), n, CHECK_POWERS, 0x38B34AE5) >> U(32)).astype(np.uint32)


def inside_rows(first_word: np.ndarray, n_words: int, n: int) -> np.ndarray:
    """For each word, whether the window of n words that starts there ends in the same row."""
    rows = np.diff(first_word)
    after = np.repeat(first_word[1:], rows)
    return np.arange(n_words) + n <= after
