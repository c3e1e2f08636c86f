"""Text steps as column expressions.

Classes are written with ``\\p{..}``: the plain ``\\w`` of the JVM knows ASCII only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

# The accented letters that are folded, and what they become.
ACCENTED = "éëèàáóíú"
PLAIN = "eeeaaoiu"

WORD = r"\p{L}\p{N}_"
SPACE = r"\s\p{Z}\x0b\x1c-\x1f\x85"
NOT_WORD = rf"[^{WORD}]"
# The characters of the class SPACE.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
PUNCTUATION = r"[!-/:-@\[-`{-~]"

# Abbreviations that do not end a sentence.
ABBREVIATIONS = """
w.c ala w.r colo w.w ga s.a.y c.o.m.b aug wed jan lt adm oct reps nov yr dr gen w.va d h l p ph.d t
r.k r.j r.i r.h s.c sep r.a m.b.a tues e.f p.a.m sen r.t h.c tenn h.f rep n.h h.m a.m.e a.m nev prof
calif a.d n.m a.g a.a a.c a.h n.d n.c jr kan a.t corp n.y a.s n.v u.s.s.r ore c ok g k e.h e.l e.m s
w ltd m.d.c sept col i.m.s okla co s.g s.p.a wash wis ct ariz maj feb chg fri s.a pa s.s n.j cos bros
mich mg d.c cie f n r ms mr fla vt dec ill va c.i.t v minn sw u.s.a d.h vs p.m ave st conn inc u.s
d.w f.g g.f g.d messrs g.k u.k f.j u.n t.j j.r j.p ft l.p j.c j.b m.j j.k j.j l.f l.a c.v e sr m b.v
mrs ky b.f
""".split()

BREAK = "\u0001"


def lowered(c: Column) -> Column:
    return F.lower(c)


def fold_accents(c: Column) -> Column:
    return F.translate(c, ACCENTED, PLAIN)


def fold_accents_drop_commas(c: Column) -> Column:
    return F.translate(c, ACCENTED + ",", PLAIN)


def strip_ends(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def clean_text(c: Column) -> Column:
    """Lower case without digits and punctuation, trimmed."""
    c = F.regexp_replace(F.lower(c), r"\p{Nd}+", "")
    return strip_ends(F.regexp_replace(c, rf"[^{WORD}{SPACE}]", ""))


def split_words(c: Column) -> Column:
    """The runs of non-blank characters."""
    return F.regexp_extract_all(c, F.lit(rf"[^{SPACE}]+"), F.lit(0))


def strip_punctuation(c: Column) -> Column:
    return F.regexp_replace(c, PUNCTUATION, " ")


def strip_non_alphanumeric(c: Column) -> Column:
    return F.regexp_replace(c, NOT_WORD, " ")


def collapse_blanks(c: Column) -> Column:
    return F.regexp_replace(c, rf"[{SPACE}]+", " ")


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(c, r"<[^>]+>", "")


def paragraph_breaks_to_blank(c: Column) -> Column:
    return F.regexp_replace(c, "\n\n", " ")


def drop_words(words: Iterable[str]) -> Callable[[Column], Column]:
    """A filter that removes the listed words."""
    listed = sorted(set(words))

    def step(c: Column) -> Column:
        kept = F.filter(split_words(c), lambda w: ~w.isin(*listed)) if listed else split_words(c)
        return F.array_join(kept, " ")

    return step


def keep_long_words(length: int) -> Callable[[Column], Column]:
    def step(c: Column) -> Column:
        return F.array_join(F.filter(split_words(c), lambda w: F.length(w) >= length), " ")

    return step


def apply_filters(c: Column, filters: Sequence[Callable[[Column], Column]]) -> Column:
    """Fold the filters over the text in order, then split into words."""
    return split_words(reduce(lambda acc, step: step(acc), filters, c))


def classification_filters(stop_words: Iterable[str], stem: Callable[[Column], Column] | None) -> list:
    """Filter chain for text classification; the stem runs before punctuation is removed."""
    chain = [lowered] + ([stem] if stem else [])
    return chain + [strip_punctuation, strip_non_alphanumeric, drop_words(stop_words), collapse_blanks]


def vector_filters(length: int = 4) -> list:
    """Filter chain for word vectors; short words go before punctuation is removed."""
    return [lowered, keep_long_words(length), collapse_blanks, strip_tags, strip_non_alphanumeric]


def sentences(c: Column, abbreviations: Iterable[str] = ABBREVIATIONS) -> Column:
    """Split after ``.``, ``!`` or ``?`` before a capital, except after an abbreviation.

    Candidate breaks are marked first; only at a mark is the word before it compared with the list.
    """
    marked = F.regexp_replace(c, r"([.!?][\"')\]]*)(\s+[\"'(\[]*\p{Lu})", f"$1{BREAK}$2")
    listed = "|".join(a.replace(".", r"\.") for a in sorted(set(abbreviations)))
    if listed:
        marked = F.regexp_replace(marked, rf"{BREAK}(?<=(?:^|{NOT_WORD})(?i:{listed})\.{BREAK})", "")
    return F.filter(F.transform(F.split(marked, BREAK), strip_ends), lambda s: F.length(s) > 0)


def join_compounds(c: Column, names: Iterable[str]) -> Column:
    """Write every multi-word name with underscores, longest name first."""
    compounds = sorted({n for n in names if len(n.split()) > 1}, key=lambda n: (-len(n), n))
    return reduce(lambda acc, n: F.replace(acc, F.lit(n), F.lit("_".join(n.split()))), compounds, c)


def chapters(c: Column, marker: str = "CHAPTER") -> Column:
    return F.split(c, rf"\Q{marker}\E")


def paragraphs(c: Column, blank_lines: bool = False) -> Column:
    """Split on an empty line; ``blank_lines`` also accepts lines that hold only blanks."""
    return F.split(c, r"\n\s*\n" if blank_lines else "\n\n")
