"""Text preparation and mentions over whole documents."""

from __future__ import annotations

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from corvane.functions import stem, text as t
from corvane.operators import cooccurrence, mentions
from corvane.plans.registry import query
from corvane.plans.tables import document_mentions, documents, entity_dictionary, folded, mention_graph, table


def _fold(c: str) -> str:
    return f"translate({c}, '{t.ACCENTED}', '{t.PLAIN}')"


def _strip(c: str) -> str:
    return rf"regexp_replace({c}, '^[{t.SPACE}]+|[{t.SPACE}]+$', '', 'g')"


def _words(c: str) -> str:
    return rf"regexp_extract_all({c}, '[^{t.SPACE}]+')"


def _folded(c: str) -> str:
    return f"lower({_fold(f'lower({c})')})"


def stop_words(spark) -> list[str]:
    """The English list that ships with Spark."""
    return StopWordsRemover.loadDefaultStopWords("english")


# A short list for the query with SQL, so that the text of the SQL stays readable.
FEW_WORDS = ["the", "and", "of", "to", "in", "le", "la", "de", "et", "el", "der", "die", "und"]


@query(
    "accent_fold",
    f"""SELECT doc_id, {_fold('text')} AS folded,
               translate(text, '{t.ACCENTED},', '{t.PLAIN}') AS without_commas FROM documents""",
)
def accent_fold(spark, folder):
    c = F.col("text")
    return documents(spark, folder).select(
        "doc_id", t.fold_accents(c).alias("folded"), t.fold_accents_drop_commas(c).alias("without_commas")
    )


@query(
    "clean_text",
    "SELECT doc_id, "
    + _strip(rf"regexp_replace(regexp_replace(lower(text), '\p{{Nd}}+', '', 'g'), '[^{t.WORD}{t.SPACE}]', '', 'g')"
    )
    + " AS cleaned FROM documents",
)
def clean_text(spark, folder):
    return documents(spark, folder).select("doc_id", t.clean_text(F.col("text")).alias("cleaned"))


_LONG = "array_to_string(list_filter(" + _words("lower(text)") + ", lambda w: length(w) >= 4), ' ')"


@query(
    "tokens_min_len",
    "SELECT doc_id, array_to_string(tokens, ' ') AS tokens, CAST(len(tokens) AS INTEGER) AS n FROM (SELECT doc_id, "
    + _words(rf"regexp_replace(regexp_replace(regexp_replace({_LONG}, '[{t.SPACE}]+', ' ', 'g'), '<[^>]+>', '', 'g'),"
        rf" '{t.NOT_WORD}', ' ', 'g')"
    )
    + " AS tokens FROM documents)",
)
def tokens_min_len(spark, folder):
    tokens = t.apply_filters(F.col("text"), t.vector_filters(4))
    return documents(spark, folder).select("doc_id", tokens.alias("tokens")).select(
        "doc_id", F.array_join("tokens", " ").alias("tokens"), F.size("tokens").alias("n")
    )


@query(
    "filter_chain_no_stem",
    "SELECT doc_id, array_to_string(list_filter("
    + _words(rf"regexp_replace(regexp_replace(lower(text), '{t.PUNCTUATION}', ' ', 'g'), '{t.NOT_WORD}', ' ', 'g')"
    )
    + ", lambda w: w NOT IN ("
    + ", ".join(f"'{w}'" for w in FEW_WORDS)
    + ")), ' ') AS tokens FROM documents",
)
def filter_chain_no_stem(spark, folder):
    tokens = t.apply_filters(F.col("text"), t.classification_filters(FEW_WORDS, None))
    return documents(spark, folder).select("doc_id", F.array_join(tokens, " ").alias("tokens"))


@query("stem_tokens")
def stem_tokens(spark, folder):
    """The whole filter chain with the stemmer, one flat list per document.

    Sentences break at blanks and the chain works word by word, so the lists of the sentences laid
    end to end are the list of the whole text; no sentence has to be cut out and put back.
    """
    words = t.classification_filters(stop_words(spark), stem.stem_text)
    tokens = t.apply_filters(F.col("text"), words)
    return documents(spark, folder).select("doc_id", tokens.alias("tokens")).select(
        "doc_id", F.array_join("tokens", " ").alias("tokens"), F.size("tokens").alias("n")
    )


_ABBR = "|".join(a.replace(".", r"\.") for a in sorted(set(t.ABBREVIATIONS)))


@query(
    "sentences",
    rf"""WITH m AS (SELECT doc_id, regexp_replace(text, '([.!?]["'')\]]*)(\s+["''(\[]*\p{{Lu}})',
                                                  '\1' || chr(1) || '\2', 'g') AS x FROM documents),
              u AS (SELECT doc_id, regexp_replace(x, '(^|{t.NOT_WORD})({_ABBR})\.' || chr(1), '\1\2.', 'gi') AS x FROM m),
              s AS (SELECT doc_id, list_filter(list_transform(string_split(x, chr(1)),
                      lambda y: {_strip('y')}), lambda y: length(y) > 0) AS l FROM u)
         SELECT doc_id, generate_subscripts(l, 1) - 1 AS sentence_no, unnest(l) AS sentence FROM s""",
)
def sentences(spark, folder):
    return documents(spark, folder).select(
        "doc_id", F.posexplode(t.sentences(F.col("text"))).alias("sentence_no", "sentence")
    ).withColumn("sentence_no", F.col("sentence_no").cast("bigint"))


_SPACED = "replace(text, '.' || chr(10), '.' || chr(10) || chr(10))"


@query(
    "paragraphs",
    f"""WITH s AS (SELECT doc_id, string_split({_SPACED}, chr(10) || chr(10)) AS l FROM documents)
        SELECT doc_id, generate_subscripts(l, 1) - 1 AS para_no, unnest(l) AS text FROM s""",
)
def paragraphs(spark, folder):
    spaced = F.replace(F.col("text"), F.lit(".\n"), F.lit(".\n\n"))
    found = mentions.paragraphs_of(documents(spark, folder), "doc_id", t.paragraphs(spaced))
    return found.withColumn("para_no", F.col("para_no").cast("bigint"))


@query(
    "paragraph_flatten",
    f"SELECT doc_id, replace({_SPACED}, chr(10) || chr(10), ' ') AS text FROM documents",
)
def paragraph_flatten(spark, folder):
    spaced = F.replace(F.col("text"), F.lit(".\n"), F.lit(".\n\n"))
    return documents(spark, folder).select("doc_id", t.paragraph_breaks_to_blank(spaced).alias("text"))


@query(
    "chapter_split",
    """WITH s AS (SELECT doc_id, string_split(text, 'The') AS l FROM documents)
       SELECT doc_id, generate_subscripts(l, 1) - 1 AS chapter_no, unnest(l) AS text FROM s""",
)
def chapter_split(spark, folder):
    pieces = F.posexplode(t.chapters(F.col("text"), "The")).alias("chapter_no", "text")
    found = documents(spark, folder).select("doc_id", pieces)
    return found.withColumn("chapter_no", F.col("chapter_no").cast("bigint"))


@query(
    "compound_names",
    """SELECT p_partkey, 'the ' || replace(p_name, ' ', '_') || ' is ' || lower(p_type) AS text FROM part""",
)
def compound_names(spark, folder):
    """Two-word names written as one word; the list of names is a literal, so its size is checked."""
    part = table(spark, folder, "part")
    names = [r.p_name for r in part.select("p_name").distinct().limit(1001).collect()]
    if len(names) > 1000:
        raise ValueError("too many names for a literal list")
    sentence = F.concat(F.lit("the "), "p_name", F.lit(" is "), F.lower("p_type"))
    return part.select("p_partkey", t.join_compounds(sentence, names).alias("text"))


DICTIONARY_SQL = rf"""
dict AS (SELECT word FROM
          (SELECT word, count(*) AS df FROM
             (SELECT DISTINCT doc_id, unnest(regexp_extract_all({_folded('text')}, '\p{{L}}{{5,}}')) AS word
              FROM documents)
           GROUP BY word ORDER BY df DESC, word LIMIT 350)
         ORDER BY df DESC, word OFFSET 300)"""
MENTIONS_SQL = f"""{DICTIONARY_SQL},
lines AS (SELECT doc_id, generate_subscripts(l, 1) - 1 AS line_no, unnest(l) AS line
          FROM (SELECT doc_id, string_split({_folded('text')}, chr(10)) AS l FROM documents)),
mentions AS (SELECT DISTINCT doc_id, line_no, word AS entity FROM lines JOIN dict ON contains(line, word))"""
MENTION_EDGES_SQL = """
medges AS (SELECT a.entity AS src, b.entity AS dst, count(*) AS weight
           FROM mentions a JOIN mentions b ON a.doc_id = b.doc_id AND a.line_no = b.line_no AND a.entity < b.entity
           GROUP BY 1, 2)"""


@query("entity_dictionary", f"WITH {DICTIONARY_SQL} SELECT word AS entity FROM dict")
def dictionary(spark, folder):
    return entity_dictionary(spark, folder).select("entity")


@query("mention_counts", f"WITH {MENTIONS_SQL} SELECT entity, count(*) AS n_lines FROM mentions GROUP BY entity")
def mention_counts(spark, folder):
    return mentions.mention_counts(document_mentions(spark, folder))


@query(
    "first_mentions",
    f"WITH {MENTIONS_SQL} SELECT doc_id, entity, min(line_no) AS line_no FROM mentions GROUP BY doc_id, entity",
)
def first_mentions(spark, folder):
    found = mentions.first_mentions(document_mentions(spark, folder), ["doc_id"], "line_no")
    return found.withColumn("line_no", F.col("line_no").cast("bigint"))


@query("mention_graph_edges", f"WITH {MENTIONS_SQL}, {MENTION_EDGES_SQL} SELECT src, dst, weight FROM medges")
def mention_graph_edges(spark, folder):
    return mention_graph(spark, folder)[1]


@query("mention_graph_nodes", f"WITH {MENTIONS_SQL} SELECT DISTINCT entity AS id FROM mentions")
def mention_graph_nodes(spark, folder):
    return mention_graph(spark, folder)[0]


@query(
    "alias_rewrite",
    f"""WITH {MENTIONS_SQL}, names AS (SELECT word AS alias, min(word) OVER (PARTITION BY substr(word, 1, 2)) AS entity FROM dict)
        SELECT n.entity, count(DISTINCT (m.doc_id, m.line_no)) AS n_lines
        FROM mentions m JOIN names n ON n.alias = m.entity GROUP BY n.entity""",
)
def alias_rewrite(spark, folder):
    """Aliases with the same first letters name one entity; a line counts once per entity."""
    names = entity_dictionary(spark, folder)
    stems = names.groupBy(F.substring("alias", 1, 2).alias("stem")).agg(F.min("alias").alias("entity"))
    aliases = names.select("alias", F.substring("alias", 1, 2).alias("stem")).join(stems, "stem").select("alias", "entity")
    lines = mentions.lines_of(documents(spark, folder), "doc_id")
    searchable = lines.select("doc_id", "line_no", folded(F.col("line")).alias("line"))
    return mentions.mention_counts(mentions.match_entities(searchable, "line", aliases))


@query(
    "whole_word_mentions",
    rf"""WITH {DICTIONARY_SQL},
         lines AS (SELECT doc_id, generate_subscripts(l, 1) - 1 AS line_no, unnest(l) AS line
                   FROM (SELECT doc_id, string_split({_folded('text')}, chr(10)) AS l FROM documents)),
         padded AS (SELECT doc_id, line_no, ' ' || regexp_replace(line, '{t.NOT_WORD}+', ' ', 'g') || ' ' AS line FROM lines)
         SELECT word AS entity, count(*) AS n_lines FROM padded JOIN dict ON contains(line, ' ' || word || ' ')
         GROUP BY word""",
)
def whole_word_mentions(spark, folder):
    lines = mentions.lines_of(documents(spark, folder), "doc_id")
    searchable = lines.select("doc_id", "line_no", folded(F.col("line")).alias("line"))
    found = mentions.match_entities(searchable, "line", entity_dictionary(spark, folder), match="word")
    return mentions.mention_counts(found)


@query(
    "coorder_graph_edges",
    """WITH e AS (SELECT DISTINCT l_orderkey AS g, l_partkey AS i FROM lineitem)
       SELECT a.i AS src, b.i AS dst, count(*) AS weight FROM e a JOIN e b ON a.g = b.g AND a.i < b.i
       GROUP BY 1, 2""",
)
def coorder_graph_edges(spark, folder):
    return cooccurrence.cooccurrence_edges(table(spark, folder, "lineitem"), "l_orderkey", "l_partkey")


@query(
    "pairs_null_group",
    """WITH items AS (SELECT DISTINCT CASE WHEN l_returnflag <> 'R' THEN l_orderkey END AS g, l_partkey AS i FROM lineitem)
       SELECT a.i AS src, b.i AS dst, count(*) AS weight
       FROM items a JOIN items b ON a.g = b.g AND a.i < b.i GROUP BY 1, 2""",
)
def pairs_null_group(spark, folder):
    """Items without a group, here what was returned, are linked to nothing."""
    items = table(spark, folder, "lineitem").select(
        F.when(F.col("l_returnflag") != "R", F.col("l_orderkey")).alias("g"), "l_partkey"
    )
    return cooccurrence.cooccurrence_edges(items, "g", "l_partkey")
