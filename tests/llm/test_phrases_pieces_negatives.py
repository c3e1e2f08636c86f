"""Collocations, SentencePiece and hard negatives against plain versions."""

import hashlib
import math
import random
import re
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece

from corvane.llm import collocations, negatives, pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def plain_collocations(rows, least, first):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    counts, n = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(lower)):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in (1, 2, 3):
                for i in range(len(words) - size + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + size])] += 1
    out = []
    for lang, f in counts.items():
        found = []
        for phrase, a in f.items():
            if len(phrase) == 1 or a < least:
                continue
            if len(phrase) == 2 and any(len(x) == 3 and c >= least and phrase in (x[:2], x[1:]) and 2 * c >= a for x, c in f.items()):
                continue
            cuts = [(10**6 * a * a // (f[phrase[:k]] * f[phrase[k:]]), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(phrase).encode(), f[phrase[:k]], f[phrase[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:first], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def found_collocations(df, **options):
    columns = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    return sorted(tuple(r[c] for c in columns) for r in collocations.collocations(df, **options).collect())


def phrase_rows():
    random.seed(3)
    words = ["the", "The", "new", "york", "é", "x", "aa", "of", "b" * 300]
    rows = [("".join(random.choice(words) + random.choice([" ", " ", "  ", "\t", ". ", "\n", ", "]) for _ in range(random.randint(0, 60))),
             random.choice(["en", "fr", None, "und", ""])) for _ in range(120)]
    return rows + [(None, "en"), ("", "fr"), (" .. ", None), ("new york city " * 3000, "en"), *[("a a a a", "xx")] * 5]


@pytest.mark.parametrize("slice_rows", [200_000, 7])
def test_collocations(spark, monkeypatch, slice_rows):
    """Ties, overlaps, null and empty texts, null languages, a long text, and slices that cut a word's phrases."""
    monkeypatch.setattr(collocations, "SLICE_ROWS", slice_rows)
    rows = phrase_rows()
    docs = spark.createDataFrame([(i, *r, "z") for i, r in enumerate(rows)], "doc_id long, text string, lang string, phrase string")
    assert found_collocations(docs, least=5, first=30) == plain_collocations(rows, 5, 30)


def test_collocations_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert found_collocations(docs) == []


def test_triples_need_no_exact_bitmap():
    """A full bitmap lets every triple through; its counts are exact all the same."""
    import numpy as np
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(["en", "en"]), pa.array(["a b c a b c", "a b. c a"])], names=["lang", "text"])
    rows = [r for b in collocations.triples(iter([batch]), np.full(collocations.PAIR_BITS // 8, 255, dtype=np.uint8)) for r in b.to_pylist()]
    assert {r["phrase"]: r["f"] for r in rows} == {"a b c": 2, "b c a": 1, "c a b": 1}


def odd_texts():
    random.seed(5)
    parts = ["a", "b", "e", "th", " ", "  ", "▁", "\n", "\t", "é", "́", "ｆ", "𝔘", "🙂", "\x00", "<s>", "<unk>", "<0x41>", "　", "the", "ing", "01", "."]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 40))) for _ in range(400)]
    return [*texts, None, "", " ", "▁" * 3000, "ab" * 30000, "x y " * 20000, "a" * 100, "thethe" * 9]


def test_sentencepiece(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = odd_texts()
    docs = spark.createDataFrame([(i if i % 5 else None, t, "z") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    expected = []
    for i, t in enumerate(texts):
        ids = library.encode(t or "")
        expected.append((i if i % 5 else None, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
    found = pieces.encode_decode(docs, MODEL, digests=True).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))
    row = pieces.encode_decode(docs.limit(2), MODEL).first()
    assert row.ids == library.encode(texts[0] or "") and row.decoded == library.decode(row.ids)
    assert pieces.encode_decode(docs.limit(0), MODEL).count() == 0


def test_agenda_of_long_and_short_units_agree(monkeypatch):
    words = pieces.Vocabulary(open(MODEL, "rb").read())
    random.seed(6)
    units = ["".join(random.choice("andethiougrs▁é🙂") for _ in range(random.randint(1, 40))) for _ in range(2000)]
    short = words.merge(units)
    monkeypatch.setattr(pieces, "SHORT", (0,))
    assert words.merge(units) == short


def test_decoding_of_any_ids():
    words = pieces.Vocabulary(open(MODEL, "rb").read())
    random.seed(7)
    for _ in range(2000):
        ids = [random.randrange(32000) if random.random() < 0.5 else random.randrange(262) for _ in range(random.randint(0, 12))]
        assert words.decode(ids) == words.library.decode(ids)


def plain_negatives(rows):
    """Rows of (id, vector, label) with distinct ids."""
    usable = [(i, [math.floor(256 * x) for x in v], g) for i, v, g in rows if i is not None and g is not None and v is not None
              and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, v, g in usable:
        if i % 50:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, h) for j, w, h in usable if j != i]  # noqa: B905
        for p, j, _ in sorted(x for x in scored if x[2] == g)[:5]:
            fit = sorted(x for x in scored if x[2] != g and -50 * p <= -100 * x[0] <= -95 * p)[:3]
            out += [(i, j, rank, k, -p, -s) for rank, (s, k, _) in enumerate(fit, 1)]
    return sorted(out)


def found_negatives(df):
    columns = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted(tuple(r[c] for c in columns) for r in negatives.mine(df, df["vec_id"] % 50 == 0).collect())


def vector_rows(n, spread, seed):
    random.seed(seed)
    rows = [(i, [random.gauss(0, spread) for _ in range(6)], random.randrange(3)) for i in range(n)]
    copies = [(n + i, rows[100][1], random.randrange(3)) for i in range(n // 3)]  # a third are equal
    odd = [(None, [1.0] * 6, 1), (5 * n, None, 1), (5 * n + 1, [1.0, None, 0, 0, 0, 0], 1), (5 * n + 2, [math.nan] * 6, 1),
           (5 * n + 3, [math.inf] * 6, 1), (5 * n + 4, [1.0] * 6, None), (5 * n + 50, [0.0] * 6, 2)]
    return rows + copies + [(i, v if v is None else [None if x is None else float(x) for x in v], g) for i, v, g in odd]


VECTORS = "vec_id long, embedding array<double>, label int"


@pytest.mark.parametrize("spread", [0.3, 1e9, 1e15])
def test_negatives(spark, spread):
    """Ties, nulls, odd numbers; products that need more than a double."""
    rows = vector_rows(400, spread, 11)
    found, expected = found_negatives(spark.createDataFrame(rows, VECTORS)), plain_negatives(rows)
    cap = lambda x: min(max(x, -(1 << 63)), (1 << 63) - 1)
    assert found == sorted((*x[:4], cap(x[4]), cap(x[5])) for x in expected)
    assert len({x[0] for x in found}) > 3


def test_negatives_in_many_teams_and_buckets(spark, monkeypatch):
    monkeypatch.setattr(negatives, "TEAM_BYTES", 150)
    monkeypatch.setattr(negatives, "BUCKET_BYTES", 2000)
    monkeypatch.setattr(negatives, "CELLS", 50)
    rows = vector_rows(300, 0.3, 12)
    assert found_negatives(spark.createDataFrame(rows, VECTORS)) == plain_negatives(rows)


def test_negatives_of_few_rows(spark):
    assert found_negatives(spark.createDataFrame([], VECTORS)) == []
    assert found_negatives(spark.createDataFrame([(0, [1.0], 1)], VECTORS)) == []
    twice = spark.createDataFrame([(0, [1.0], 1), (0, [2.0], 1), (1, [4.0], 1), (2, [3.0], 2), (2, [3.0], 2)], VECTORS)
    assert found_negatives(twice) == [(0, 1, 1, 2, 256 * 1024, 256 * 768)]
