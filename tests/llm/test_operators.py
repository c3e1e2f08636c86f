import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corvane.llm import coder, components, decontam, forest, language, neighbours, packing, queries, spans, tokens, toxicity, urls
from tests.llm import plain

DOCS = "doc_id long, text string, chunk int, rest string, n_words string, h int"  # names that the operators use themselves


def table(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, 1, "x", None, 7) for i, t in rows], DOCS).repartition(parts)


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, plain.documents()).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize(("dedup", "length"), [(spans.substring_dedup, 20), (spans.suffix_dedup, 50)])
def test_repeats_match_the_plain_version(spark, docs, dedup, length):
    want = plain.left_after_repeats(plain.documents(), length)
    got = dedup(docs, length, join_words=True, chunk_bytes=2000).collect()
    assert len(got) == len(plain.documents())
    texts = dict(plain.documents())
    for r in got:
        left = want[(r.doc_id, texts[r.doc_id])][0]
        assert (r.text, r.n_removed) == (" ".join(left), len(plain.words(texts[r.doc_id])) - len(left))
        assert sum(s["words"] for s in r.removed_spans) == r.n_removed
        assert (r.chunk, r.rest, r.h) == (1, "x", 7)


def test_repeats_keep_spacing_nulls_and_repeated_rows(spark, none):
    passage = plain.prose(3, 30)
    rows = [(1, passage), (1, passage), (2, "Start\n\n" + passage + " \n end  here"), (None, passage), (3, None)]
    got = spans.substring_dedup(table(spark, rows), 20).collect()
    texts = sorted((r.doc_id is not None, r.doc_id or 0, r.text is None, r.text or "") for r in got)
    # the row without an id comes first and keeps the passage
    assert texts == [(False, 0, False, passage), (True, 1, False, ""), (True, 1, False, ""), (True, 2, False, "Start\n\nend  here"), (True, 3, True, "")]
    assert spans.suffix_dedup(none, 50).count() == 0


def test_anchors_meet_in_every_alignment():
    rng = np.random.default_rng(0)
    for anchors_of, length in ((spans.cover_anchors, 20), (spans.minimiser_anchors, 50)):
        passage = rng.integers(0, 2**63, length).astype(np.uint64)
        for a in range(14):
            seen = []
            for before in (a, 5):
                h = np.concatenate([rng.integers(0, 2**63, before).astype(np.uint64), passage, rng.integers(0, 2**63, 9).astype(np.uint64)])
                at, values, n = anchors_of(h, np.array([0, len(h)]), length)
                inside = (at >= before) & (at + n <= before + length)
                seen.append(set(zip(at[inside] - before, values[inside], strict=True)))
            assert seen[0] & seen[1]


def check_packing(spark, pieces, rows, capacity, tokenizer):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append((p.offset, p.length))
    for key, text in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        own = sorted(by_doc[key], key=lambda p: p.start)
        assert [p.start for p in own] == list(np.cumsum([0] + [p.length for p in own])[:-1])
        assert sum(p.length for p in own) == len(ids) == own[0].doc_tokens
        for p in own:
            piece = ids[p.start : p.start + p.length].tobytes()
            assert (p.ids_crc32, bytes(p.ids)) == (zlib.crc32(piece), piece)
    for placed in by_sequence.values():
        placed.sort()
        ends = np.cumsum([0] + [n for _, n in placed])
        assert [o for o, _ in placed] == list(ends[:-1])
        assert ends[-1] <= capacity
    return len(by_sequence)


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.bpe_file())
    return t


@pytest.mark.parametrize(("capacity", "open_windows", "parts"), [(64, 4, 5), (1024, 256, 1), (1, 2, 2)])
def test_packing(spark, none, tokenizer, capacity, open_windows, parts):
    rows = [(k, t) for k, t in plain.documents() if capacity > 1 or len(t or "") < 500] + [(99, "a <|endoftext|> b"), (98, "x<|endoftext|>  <|endoftext|>y  <|endoftext|>")]
    pieces = packing.pack(table(spark, rows, parts), queries.bpe_file(), capacity=capacity, open_windows=open_windows, with_ids=True).collect()
    used = check_packing(spark, pieces, rows, capacity, tokenizer)
    total = sum(p.length for p in pieces)
    assert used <= -(-total // capacity) + total * 16 // 1024 // capacity + parts
    assert packing.pack(none, queries.bpe_file()).count() == 0


def test_token_files_round_trip(spark, none, tokenizer, tmp_path):
    rows = [*plain.documents(), (99, "a <|endoftext|> b<|endoftext|><|endoftext|>  c"), (100, "one"), (None, "no id")]
    coder.write_ids(table(spark, rows), queries.bpe_file(), str(tmp_path / "ids"))
    got = {r.doc_id: r for r in coder.read_ids(spark, str(tmp_path / "ids"), with_ids=True).collect()}
    start = 0
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        r = got[key]
        assert (r.start, r.n_tokens, r.ids_crc32, r.ids) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids)
        start += len(ids)
    coder.write_ids(none, queries.bpe_file(), str(tmp_path / "empty"))
    assert coder.read_ids(spark, str(tmp_path / "empty")).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 255, 256, 5000, 40_000])
def test_coder_round_trip_and_damage(n):
    rng = np.random.default_rng(n)
    ids = np.where(rng.random(n) < 0.5, rng.integers(0, 50257, n), np.arange(n) % 7)
    record = coder.write_record([3], [n], ids, 50257)
    names, sizes, back = coder.read_record(record)
    assert names == [3] and list(sizes) == [n] and (back == ids).all()
    broken = bytearray(record)
    broken[-1] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        coder.read_record(bytes(broken))


def test_toxic_documents_are_found(spark, none):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(240):
        w = plain.prose(1000 + i, 120, 3000).split()
        if i % 6 == 0:
            for k in range(4):
                w[20 + 3 * k] = rng.choice(["nastyx", "vilex", "foulx"]) + rng.choice(["", "est", "ly"])
        rows.append((i, " ".join(w)))
        labels.append((i, int(i % 6 == 0)))
    rows += [(500, None), (501, ""), (None, "nastyx vilex foulx nastyx")]
    labels += [(0, 1), (None, 1), (7, None), (9999, 1)]
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    docs = table(spark, rows)
    scored = toxicity.toxicity(docs, labels, F.col("doc_id") % 5 != 0).collect()
    assert len(scored) == len(rows)
    for r in scored:
        assert 0 <= r.score <= 1
        if r.doc_id is not None:
            assert (r.score >= 0.5) == (r.doc_id < 240 and r.doc_id % 6 == 0), r.doc_id
            assert bool(r.passages) >= (r.score >= 0.5)
    kept = toxicity.keep_clean(docs, labels, F.col("doc_id") % 5 != 0)
    assert kept.columns == docs.columns and kept.where("doc_id is not null").count() == 202
    assert toxicity.toxicity(none, labels, F.lit(True)).count() == 0
    clashing = docs.withColumn("__found", F.lit("a")).withColumn("__TEXT", F.lit("b"))
    sampled = toxicity.keep_clean(clashing, labels, F.col("doc_id") % 5 != 0, most_labels=120)
    assert sampled.columns == clashing.columns and 195 <= sampled.where("doc_id is not null").count() <= 210
    flat = toxicity.toxicity(docs, labels.where("toxic = 0"), F.lit(True))
    assert flat.select("score").distinct().count() == 1


@pytest.mark.parametrize("tenths", [1, 5, 7])
def test_toxic_documents_are_found_at_any_share(spark, tenths):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(600):
        w, toxic = plain.prose(2000 + i, 60, 2000).split(), i % 10 < tenths
        if toxic:
            for k in range(4):
                w[20 + 3 * k] = f"nasty{rng.choice('abcdefghij')}x"[rng.choice([0, 5]) :] + rng.choice("abcdefgh") * 9
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    scored = toxicity.toxicity(table(spark, rows), labels, F.col("doc_id") % 7 != 0).where("doc_id % 7 = 0").collect()
    right = sum((r.score >= 0.5) == (r.doc_id % 10 < tenths) for r in scored)
    assert right >= 0.95 * len(scored), right


def test_maximal_segments():
    assert toxicity.maximal_segments([], [], -1.0) == []
    assert toxicity.maximal_segments([2, 4], [3.0, 3.0], -1.0) == [(2, 5, 5.0)]
    assert toxicity.maximal_segments([2, 9], [3.0, 3.0], -1.0) == [(2, 3, 3.0), (9, 10, 3.0)]


def test_near_duplicates_match_the_plain_version(spark, docs, none):
    rows = plain.documents()
    want = plain.component_of(rows)
    got = forest.near_duplicates(docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {k: (len(plain.shingles(t)), want[k], want[k] == k) for k, t in rows}
    # in a dense region few proposals must do as well
    tight = forest.near_duplicates(docs, best=1).collect()
    assert {r.doc_id: r.component_id for r in tight} == want
    assert forest.keep_one(docs).count() == len(set(want.values()))
    assert forest.near_duplicates(none).count() == 0


def test_near_duplicates_among_sets_that_share_a_template(spark):
    shared = plain.prose(900, 80)
    rows = [(i, shared + " " + plain.prose(1000 + i, 40)) for i in range(1, 161)]
    rows += [(500 + i, text.rsplit(" ", 8)[0] + " " + plain.prose(2000 + i, 8)) for i, text in rows[::8]]
    want = plain.component_of(rows)
    got = forest.near_duplicates(table(spark, rows), best=1)
    assert {r.doc_id: r.component_id for r in got.collect()} == want
    assert 0 < sum(want[k] != k for k in want) < len(rows) - 100
    assert forest.keep_one(table(spark, rows).withColumn("__gone", F.lit(1))).count() == len(set(want.values()))


def test_near_duplicates_with_repeated_and_missing_ids(spark):
    a, b = plain.prose(1, 40), plain.prose(2, 40)
    got = forest.near_duplicates(table(spark, [(1, a), (5, b), (5, a), (9, b), (None, a)])).collect()
    assert sorted((r.doc_id or 0, r.component_id, r.kept) for r in got) == [(0, None, True), (1, 1, True), (5, 1, False), (5, 1, False), (9, 1, False)]


def test_components_of_a_long_path_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(300, 200), (200, 300), (7, 7)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 160), 100), 200: 200, 300: 200}


def test_contamination(spark, none):
    item, second, tiny = plain.prose(50, 30), plain.prose(51, 24), "just three words"
    cut = item.split()
    cut[3] = "other"
    rows = [
        (1, plain.prose(52, 50) + " " + item.upper() + " " + plain.prose(53, 20)), (2, item), (3, plain.prose(54, 100)), (4, None), (5, ""),
        (6, " ".join(cut[4:])), (7, plain.prose(55, 12) + " " + second), (7, "again " + second), (8, "So Just three  words here"), (None, item),
        (9, " ".join(item.split()[:15])), (10, " ".join(cut)),
    ]
    items = spark.createDataFrame([(1, item, 0), (2, second, 0), (3, None, 0), (4, "", 0), (5, tiny, 0), (1, item, 0)], "item_id long, text string, doc_id int")
    docs = table(spark, rows)
    got = sorted((r.doc_id or 0, r.item_id, round(r.similarity, 6)) for r in decontam.contaminated(docs, items).collect())
    # row 6 is shorter than the item: 22 of its 26 shingles; a changed word near one end of 30 costs 4 of 26 on either side
    assert got == [(0, 1, 1.0), (1, 1, 1.0), (2, 1, 1.0), (6, 1, round(22 / 26, 6)), (7, 2, 1.0), (8, 5, 1.0)]
    kept = decontam.keep_uncontaminated(docs.withColumn("__gone", F.lit(1)), items)
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 3, 4, 5, 9, 10]
    assert decontam.contaminated(none, items).count() == 0
    assert decontam.contaminated(docs, items.limit(0)).count() == 0


def test_url_verdicts(spark):
    day = lambda n: f"2024-03-{n:02d}"
    entries = [
        ("bad.com", "block", day(5)), ("bad.com", "remove", day(20)), ("bad.com", "allow", day(20)), ("a.bad.com", "allow", day(10)),
        ("ok.org/x", "block", day(1)), ("ok.org/x", "block", day(1)), (None, "block", day(1)), ("q.net", "odd", day(1)), ("gone.io", "block", day(1)), ("gone.io", "remove", day(2)),
    ]
    captures = [
        (1, "https://bad.com/y", day(4), "none"), (2, "https://bad.com/y", day(5), "block"), (3, "http://u:p@B.Bad.com:80/", day(19), "block"),
        (4, "https://bad.com/", day(20), "allow"), (5, "https://a.bad.com/", day(12), "allow"), (6, "https://a.bad.com", day(9), "block"),
        (7, "http://ok.org/x/z?q", day(30), "block"), (8, "http://ok.org/xx", day(30), "none"), (9, None, day(3), "none"), (10, "not a url", day(3), "none"),
        (11, "http://bad.com/", None, "none"), (12, "http://gone.io/", day(1), "block"), (13, "http://gone.io/", day(2), "none"), (13, "http://gone.io/", day(2), "none"),
        (14, "http://notbad.com/", day(6), "none"),
    ]
    c = spark.createDataFrame(captures, "capture_id long, url string, on string, want string").withColumn("on", F.to_date("on"))
    e = spark.createDataFrame(entries, "pattern string, action string, on string").withColumn("on", F.to_date("on"))
    got = sorted((r.capture_id, r.verdict) for r in urls.verdicts(c, e).collect())
    assert got == sorted((k, v) for k, _, _, v in captures)
    assert urls.verdicts(c.limit(0), e).count() == 0
    assert urls.verdicts(c, e.limit(0)).select("verdict").distinct().collect() == [("none",)]


def test_neighbours_recall_and_odd_vectors(spark):
    rng = np.random.default_rng(1)
    data = rng.normal(size=(600, 16)).round(3)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(data)]
    odd = [(1000, None), (1050, [0.0] * 16), (1100, [float("nan")] + [1.0] * 15), (1150, [None] + [1.0] * 15), (1200, [1.0, 2.0]), (None, [1.0] * 16), (1250, [1e200] * 16)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumn("score", F.lit("x"))
    got = defaultdict(list)
    for r in neighbours.nearest(df, F.col("vec_id") % 50 == 0, block=200, pivots=64, prefix=32, share=0.3).orderBy("rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert not {1000, 1050, 1100, 1150, 1200} & set(got)
    hit = 0
    for q in range(0, 600, 50):
        cosine = data @ data[q] / np.sqrt((data * data).sum(1) * (data[q] @ data[q]))
        cosine[q] = -2
        hit += len({v for v, _ in got[q]} & set(np.argsort(-cosine)[:5].tolist()))
        assert all(abs(s - cosine[v]) < 1e-12 for v, s in got[q] if v < 600)
    assert hit >= 0.9 * 60
    assert neighbours.nearest(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_neighbours_where_a_third_of_the_rows_is_equal(spark):
    rng = np.random.default_rng(2)
    data = rng.normal(size=(3000, 16)).round(3)
    equal = rng.permutation(3000)[:1000]
    data[equal] = data[equal[0]]
    data[equal[500:]] *= 2  # other lengths, same direction
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(data)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = defaultdict(set)
    for r in neighbours.nearest(df, F.col("vec_id") % 25 == 0, block=1000).collect():
        got[r.query_id].add(r.vec_id)
    unit = data / np.sqrt((data * data).sum(1))[:, None]
    hit = dict.fromkeys([False, True], 0)
    asked = dict.fromkeys([False, True], 0)
    for q in range(0, 3000, 25):
        cosine = (unit @ unit[q]).round(12)
        cosine[q] = -2
        copy = bool(q in set(equal.tolist()))
        hit[copy] += len(got[q] & set(np.lexsort((np.arange(3000), -cosine))[:5].tolist()))
        asked[copy] += 5
    assert hit[True] == asked[True] > 0
    assert hit[False] >= 0.9 * asked[False]


def test_neighbours_own_id_may_repeat():
    ids = np.array([0] * 12 + list(range(1, 9)))
    vectors, pivots = np.tile([1.0, 2.0], (20, 1)), np.eye(2)
    found = neighbours.search_block(ids, vectors, ids[:1], vectors[:1], pivots, 2, 0.1, 5)
    assert [(q, v) for q, v, _ in found] == [(0, v) for v in range(1, 6)]


def test_language_held_out(spark, none):
    parts = {"aa": ["lor", "men", "ti", "qua"], "bb": ["sch", "ung", "ber", "ein"], "cc": ["ção", "ñor", "dad", "ez"]}
    rng = random.Random(2)
    rows = []
    for i in range(180):
        lang = "abc"[i % 3] * 2
        rows.append((i, " ".join("".join(rng.choices(parts[lang], k=rng.randint(1, 4))) for _ in range(25)), lang))
    rows += [(500, None, "aa"), (501, "123 !! ", "aa"), (502, "", None), (503, "lormen " * 3 + "x" * 3000, None), (None, "schung", "bb")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = {r.doc_id: r for r in language.detect(docs, queries.bpe_file(), F.col("doc_id") % 4 != 2).collect()}
    held = [i for i in range(180) if i % 4 == 2]
    assert sum(got[i].lang_pred == "abc"[i % 3] * 2 for i in held) >= 0.95 * len(held)
    assert [(got[i].lang_pred, got[i].score) for i in (500, 501, 502)] == [("und", 0.0)] * 3
    assert got[None].lang_pred == "bb" and all(0 <= r.score <= 1 for r in got.values())
    assert {r.lang_pred for r in language.detect(docs, queries.bpe_file(), F.lit(False)).collect()} == {"und"}
    assert language.detect(docs.limit(0), queries.bpe_file(), F.lit(True)).count() == 0


def test_forward_sums_over_all_segmentations():
    pieces = sorted({b"a", b"b", b"ab", b"aba", b"ba"})
    logs = np.log(np.arange(1, 6) / 15)[:, None]
    p = {x: float(np.exp(v[0])) for x, v in zip(pieces, logs, strict=True)}

    def total(word):
        return 1.0 if not word else sum(p[word[:n]] * total(word[n:]) for n in range(1, len(word) + 1) if word[:n] in p)

    data = np.frombuffer(b"abaabbab", np.uint8)
    starts, ends = np.array([0, 3, 7]), np.array([3, 8, 8])
    vocabulary = language.Vocabulary(pieces)
    scaled = np.vstack([np.exp(logs) * language.UNIT ** vocabulary.lengths[:, None], [[0.0]]])
    got = language.Words(data, starts, ends, vocabulary).scores(scaled)[:, 0]
    assert np.allclose(got, [np.log(total(data[a:b].tobytes())) for a, b in zip(starts, ends, strict=True)])


def test_long_pieces_and_long_words():
    """Pieces over eight bytes, and words far past a scaling step, against sums of exact logarithms; expected counts too."""
    pieces = sorted({bytes([b]) for b in range(256)} | {b"ab", b"international", b"nternationaliz", b"ized", "中文".encode() * 4})
    logs = np.log(np.random.default_rng(3).dirichlet(np.full(len(pieces), 0.3), 3).T + 1e-9)
    words = [b"internationalized", b"a", "中文".encode() * 300, b"xinternational" * 90, b"ab" * 16, b"q" * 64, b"international"]
    ends = np.cumsum([len(w) for w in words])
    vocabulary = language.Vocabulary(pieces)
    scaled = np.vstack([np.exp(logs) * language.UNIT ** vocabulary.lengths[:, None], np.zeros((1, 3))])
    lattice = language.Words(np.frombuffer(b"".join(words), np.uint8), ends - [len(w) for w in words], ends, vocabulary)
    number = {piece: i for i, piece in enumerate(pieces)}
    for word, got in zip(words, lattice.scores(scaled), strict=True):
        total = [np.zeros(3)]
        for end in range(1, len(word) + 1):
            ways = [total[end - n] + logs[number[word[end - n : end]]] for n in {*map(len, pieces)} if n <= end and word[end - n : end] in number]
            total.append(np.logaddexp.reduce(ways, axis=0))
        assert np.allclose(got, total[-1], rtol=1e-9)
    short = [b"internationalized", b"international", b"ab"]
    ends = np.cumsum([len(w) for w in short])
    lattice = language.Words(np.frombuffer(b"".join(short), np.uint8), ends - [len(w) for w in short], ends, vocabulary)
    counts = lattice.expected(scaled[:, :1], np.array([2.0, 1.0, 5.0]))
    assert counts[:-1] @ vocabulary.lengths == pytest.approx(2 * 17 + 13 + 10)
    ways = np.exp(logs[:, 0])
    whole = ways[number[b"international"]]
    assert counts[number[b"international"]] > 0
    singles = np.prod([ways[number[bytes([b])]] for b in b"international"])
    only = language.Words(np.frombuffer(b"international", np.uint8), np.array([0]), np.array([13]), vocabulary)
    assert only.expected(scaled[:, :1], np.array([1.0]))[number[b"international"]] == pytest.approx(whole / (whole + singles))


def test_fit_cuts_between_characters():
    data = np.frombuffer("中".encode() * 200 + b" ab", np.uint8)
    starts, ends = language.fit_runs(data, np.array([0, len(data)]))
    assert [bytes(data[a:b]).decode() for a, b in zip(starts, ends, strict=True)] == ["中" * 85, "中" * 85, "中" * 30, "ab"]


def test_encoder_that_forgets_units_gives_the_same_ids(monkeypatch):
    """A memory far too small for the text: frequent units stay, others are learnt again, the ids are the library's."""
    monkeypatch.setattr(tokens, "MOST_UNITS", 120)
    rng = random.Random(4)
    words = ["the", "of", "naïve", "中文", "a"] + [f"w{i}x" for i in range(900)]
    texts = [" ".join(rng.choices(words[:5], k=8) + rng.choices(words, k=20)) + rng.choice(["", "\n", " <|endoftext|> b"]) for _ in range(60)] + [None, ""]
    with open(queries.bpe_file(), encoding="utf-8") as f:
        encoder = tokens.Encoder(f.read())
    for i in range(0, len(texts), 4):
        for first, last, ids, offsets in encoder.encode(pa.array(texts[i : i + 4], pa.string())):
            for row in range(first, last):
                expected = encoder._tokenizer.encode(texts[i + row] or "", add_special_tokens=False).ids
                assert ids[offsets[row - first] : offsets[row - first + 1]].tolist() == expected
    assert 0 < len(encoder._keys) < 400 and len(encoder._first) == len(encoder._met) == len(encoder._keys)


FOLDER = "/root/testdata/sf0.001"


def test_pipeline_against_plain_versions(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        docs = stage(spark, docs, FOLDER).cache()
        assert docs.columns == columns
        kept[name] = (before, {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()})
    before, after = kept["minhash_near_dedup"]
    assert set(after) == set(plain.component_of(before).values())
    before, after = kept["suffix_array_dedup"]
    want = plain.left_after_repeats(before, 50)
    assert {k: plain.words(t) for k, t in after.items()} == {k: v[0] for (k, _), v in want.items()}
    before, after = kept["benchmark_decontamination"]
    assert all(after[k] == dict(before)[k] for k in after) and len(after) < len(before)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    assert {p.doc_id for p in pieces} == set(after)


def test_op1_digest_on_given_data(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    want = plain.left_after_repeats(rows, 20)
    texts = dict(rows)
    for r in queries.QUERIES["op1_substring_dedup"](spark, FOLDER).collect():
        left = " ".join(want[(r.doc_id, texts[r.doc_id])][0])
        assert r.kept_sha256 == hashlib.sha256(left.encode()).hexdigest()
