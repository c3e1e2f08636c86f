import pyarrow as pa
from pyspark.sql import functions as F

from corvane.functions import stem, text as t
from corvane.lineage import fresh_path
from corvane.operators import mentions


def value(spark, text, column):
    return spark.createDataFrame([(text,)], "text string").select(column.alias("v")).first().v


def test_accents_are_folded_in_lower_case_only(spark):
    got = value(spark, "é,ë è à á ó í ú ê É", t.fold_accents_drop_commas(F.col("text")))
    assert got == "ee e a a o i u ê É"
    assert value(spark, "é,", t.fold_accents(F.col("text"))) == "e,"


def test_clean_text_keeps_letters_of_all_scripts(spark):
    got = value(spark, "  Ça, 12 c'est_l'été!  Ünïque-9 ", t.clean_text(F.col("text")))
    assert got == "ça  cest_lété  ünïque"


def test_long_words_are_kept_before_punctuation_goes(spark):
    got = value(spark, "the <b>and, word_one it's a-b-c xyz", t.apply_filters(F.col("text"), t.vector_filters(4)))
    # "and," has four characters with its comma, and "it's" splits after the length test
    assert got == ["and", "word_one", "it", "s", "a", "b", "c"]


def test_filter_chain_stems_before_punctuation(spark):
    chain = t.classification_filters(["the", "of"], stem.stem_text)
    got = value(spark, "The cats running, running of the ponies", t.apply_filters(F.col("text"), chain))
    assert got == ["cat", "running", "run", "poni"]


def test_published_stems():
    pairs = """caresses caress ponies poni ties ti caress caress cats cat feed feed agreed agre plastered plaster
    bled bled motoring motor sing sing conflated conflat troubled troubl sized size hopping hop tanned tan falling fall
    hissing hiss fizzed fizz failing fail filing file happy happi sky sky relational relat conditional condit
    rational ration valenci valenc hesitanci hesit digitizer digit radicalli radic differentli differ vileli vile
    analogousli analog vietnamization vietnam predication predic operator oper feudalism feudal decisiveness decis
    hopefulness hope callousness callous formaliti formal sensitiviti sensit sensibiliti sensibl triplicate triplic
    formative form formalize formal electriciti electr electrical electr hopeful hope goodness good revival reviv
    allowance allow inference infer airliner airlin gyroscopic gyroscop adjustable adjust defensible defens
    irritant irrit replacement replac adjustment adjust dependent depend adoption adopt homologou homolog
    communism commun activate activ angulariti angular homologous homolog effective effect bowdlerize bowdler
    probate probat rate rate cease ceas controll control roll roll""".split()
    assert [(w, stem.stem_word(w)) for w in pairs[::2]] == list(zip(pairs[::2], pairs[1::2]))


def test_sentences_hold_after_abbreviations(spark):
    text = 'Mr. Smith met Dr. Jones at 5 p.m. in the U.S. Senate. He left! "Why?" Nobody knew. ok. so'
    assert value(spark, text, t.sentences(F.col("text"))) == [
        "Mr. Smith met Dr. Jones at 5 p.m. in the U.S. Senate.",
        "He left!",
        '"Why?"',
        "Nobody knew. ok. so",
    ]
    assert value(spark, "Mr. A. Then", t.sentences(F.col("text"), [])) == ["Mr.", "A.", "Then"]


def test_sentence_lists_end_to_end_are_the_list_of_the_text(spark):
    text = "The dogs were running. Dr. No hopped, skipped!  Why?\nThey agreed (mostly). Ponies..."
    chain = t.classification_filters(["the", "were"], stem.stem_text)
    df = spark.createDataFrame([(text,)], "text string")
    pieces = df.select(F.posexplode(t.sentences(F.col("text"))).alias("n", "s"))
    lists = [r.v for r in pieces.select("n", t.apply_filters(F.col("s"), chain).alias("v")).orderBy("n").collect()]
    assert len(lists) > 3 and sum(lists, []) == df.select(t.apply_filters(F.col("text"), chain).alias("v")).first().v


def test_longest_compound_first(spark):
    got = value(spark, "count rostov and count rostov junior", t.join_compounds(F.col("text"), ["count rostov", "count rostov junior", "anna"]))
    assert got == "count_rostov and count_rostov_junior"


def test_paragraphs_and_chapters(spark):
    assert value(spark, "a\nb\n\nc\n \nd", t.paragraphs(F.col("text"))) == ["a\nb", "c\n \nd"]
    assert value(spark, "a\nb\n\nc\n \nd", t.paragraphs(F.col("text"), blank_lines=True)) == ["a\nb", "c", "d"]
    assert value(spark, "x CHAPTER 1 CHAPTER 2", t.chapters(F.col("text"))) == ["x ", " 1 ", " 2"]


LINES = [(1, "anna met boris and joanna"), (2, "marya karagina"), (3, "nobody"), (4, "anna-marie, boris")]


def found(lines, dictionary, **options):
    rows = mentions.match_entities(lines, "line", dictionary, **options).collect()
    return sorted((r.id, r.entity) for r in rows)


def test_literal_and_joined_dictionaries_agree(spark):
    lines = spark.createDataFrame(LINES, "id int, line string")
    names = spark.createDataFrame(
        [("anna", "anna"), ("boris", "boris"), ("karagina", "karagina"), ("marya karagina", "marya"), ("jo", "jo")],
        "alias string, entity string",
    )
    substring = [(1, "anna"), (1, "boris"), (1, "jo"), (2, "karagina"), (2, "marya"), (4, "anna"), (4, "boris")]
    words = [p for p in substring if p != (1, "jo")]
    for limit in (500, 1):
        assert found(lines, names, inline_limit=limit) == substring
        assert found(lines, names, match="word", inline_limit=limit) == words


def test_two_aliases_of_one_entity_count_once_per_line(spark):
    lines = spark.createDataFrame([(1, "count rostov, count ilya rostov"), (2, "count ilya rostov")], "id int, line string")
    names = spark.createDataFrame(
        [("count rostov", "rostov"), ("count ilya rostov", "rostov")], "alias string, entity string"
    )
    counts = mentions.mention_counts(mentions.match_entities(lines, "line", names)).collect()
    assert [(r.entity, r.n_lines) for r in counts] == [("rostov", 2)]


def test_column_functions_run_on_a_stream(spark):
    path = fresh_path(spark, "stream")
    spark.createDataFrame([("Été, 1812",)], "text string").write.parquet(path)
    stream = spark.readStream.schema("text string").parquet(path).select(t.clean_text(F.col("text")).alias("v"))
    query = stream.writeStream.format("memory").queryName("cleaned").outputMode("append").start()
    try:
        query.processAllAvailable()
        assert [r.v for r in spark.table("cleaned").collect()] == ["été"]
    finally:
        query.stop()


def test_the_stemmer_takes_a_batch_apart_in_slices(monkeypatch):
    monkeypatch.setattr(stem, "SLICE_BYTES", 20)
    texts = ["running dogs", None, "", "a" * 70 + "s " + "cats " * 9, "éclairs ponies", "x"]
    batches = [pa.array(texts, pa.string()), pa.array([], pa.string()), pa.array(["motoring"], pa.string())]
    sizes = [len(x) for x in stem._slices(batches[0])]
    assert len(sizes) > 2 and sum(sizes) == len(texts)
    found = [x.to_pylist() for x in stem.stem_batches(iter(batches))]
    assert found[1:] == [[], ["motor"]]
    assert found[0] == [None if t is None else " ".join(stem.stem_word(w) for w in t.split()) for t in texts]
