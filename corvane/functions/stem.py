"""Porter's suffix stripper (M.F. Porter, 1980), applied word by word in Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F, types as T

# The suffix tables of the published algorithm, with the later revision
# of its author ("bli", "logi").
STEP_2 = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
    ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
    ("logi", "log"),
]
STEP_3 = [
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""),
    ("ness", ""),
]
STEP_4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou",
    "ism", "ate", "iti", "ous", "ive", "ize",
]

LONG_WORD = 64  # a worker remembers the stems of words up to this length
SLICE_BYTES = 1 << 20  # text that is taken apart at a time

_VOWEL_RUNS = re.compile("v+c")


def _shape(stem: str) -> str:
    """One letter per character: ``v`` for a vowel, ``c`` for a consonant."""
    out = []
    for i, ch in enumerate(stem):
        vowel = ch in "aeiou" or (ch == "y" and i > 0 and out[-1] == "c")
        out.append("v" if vowel else "c")
    return "".join(out)


def _measure(stem: str) -> int:
    return len(_VOWEL_RUNS.findall(_shape(stem)))


def _has_vowel(stem: str) -> bool:
    return "v" in _shape(stem)


def _double(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _short_end(word: str) -> bool:
    return len(word) > 2 and _shape(word)[-3:] == "cvc" and word[-1] not in "wxy"


def _longest(word: str, suffixes) -> str | None:
    return max((s for s in suffixes if word.endswith(s)), key=len, default=None)


def _plural(w: str) -> str:
    if w.endswith("sses") or w.endswith("ies"):
        return w[:-2]
    return w[:-1] if w.endswith("s") and not w.endswith("ss") else w


def _past(w: str) -> str:
    if w.endswith("eed"):
        return w[:-1] if _measure(w[:-3]) > 0 else w
    ending = _longest(w, ("ed", "ing"))
    if ending is None or not _has_vowel(w[: -len(ending)]):
        return w
    w = w[: -len(ending)]
    if w.endswith(("at", "bl", "iz")):
        return w + "e"
    if _double(w):
        return w if w[-1] in "lsz" else w[:-1]
    return w + "e" if _measure(w) == 1 and _short_end(w) else w


def _swap(w: str, table) -> str:
    pairs = dict(table)
    ending = _longest(w, pairs)
    if ending is None or _measure(w[: -len(ending)]) == 0:
        return w
    return w[: -len(ending)] + pairs[ending]


def _cut(w: str) -> str:
    ending = _longest(w, STEP_4)
    if ending is None:
        return w
    rest = w[: -len(ending)]
    if ending == "ion" and not rest.endswith(("s", "t")):
        return w
    return rest if _measure(rest) > 1 else w


def _tidy(w: str) -> str:
    if w.endswith("e"):
        m = _measure(w[:-1])
        if m > 1 or (m == 1 and not _short_end(w[:-1])):
            w = w[:-1]
    return w[:-1] if w.endswith("ll") and _measure(w[:-1]) > 1 else w


def stem_word(word: str) -> str:
    w = word.lower()
    if len(w) <= 2:
        return w
    w = _past(_plural(w))
    if w.endswith("y") and _has_vowel(w[:-1]):
        w = w[:-1] + "i"
    return _tidy(_cut(_swap(_swap(w, STEP_2), STEP_3)))


_stem_met = lru_cache(maxsize=200_000)(stem_word)


def _stem(word: str) -> str:
    return _stem_met(word) if len(word) <= LONG_WORD else stem_word(word)


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Runs of rows that hold about ``SLICE_BYTES`` of text, or one longer text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    first = 0
    while first < len(texts):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + SLICE_BYTES, side="right")))
        yield texts.slice(first, last - first)
        first = last


def stem_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Stemmed texts of each batch; words and texts are Python objects for one slice of it at a time."""
    for texts in batches:
        done = [pa.array([], pa.string())]
        for part in _slices(texts):
            found = [None if t is None else " ".join([_stem(w) for w in t.split()]) for t in part.to_pylist()]
            done.append(pa.array(found, pa.string()))
        yield pa.concat_arrays(done)


_stem_texts = F.arrow_udf(T.StringType())(stem_batches)


def stem_text(c: Column) -> Column:
    """Stem every blank-separated word of the text."""
    return _stem_texts(c)
