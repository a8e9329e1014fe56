"""Text statistics, keyword counts and the brand heuristic as Catalyst expressions.

Counts use regex classes equal to Python's ``str`` predicates (see ``charclass``): a count of a
class is ``length(text) - length(regexp_replace(text, class, ''))``. Lengths are in code points.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C
from .charclass import UPPER_CLASS, digit_chars, ws_chars, ws_class

STAT_FIELDS = ["text_length", "word_count", "digit_count", "special_char_count", "uppercase_ratio", "avg_word_length"]
KEYWORD_FIELDS = ["has_quality_keywords", "quality_keyword_count", "has_discount_keywords", "discount_keyword_count"]
BRAND_FIELDS = ["has_brand", "brand_position", "potential_brand"]


def clean_text(c: Column) -> Column:
    """NULL -> '' and anything -> string."""
    return F.coalesce(c.cast("string"), F.lit(""))


def count_class(text: Column, cls: str) -> Column:
    """Characters of ``text`` in a single-character class (one regex match per character: use for
    rare classes or short texts; ``count_runs_complement`` is cheaper for common ones)."""
    return F.length(text) - F.length(F.regexp_replace(text, cls, ""))


def count_runs_complement(text: Column, complement: str) -> Column:
    """Characters NOT in ``complement`` (a class body): delete runs of the complement, measure the rest.
    Deleting runs needs one match per run instead of one per character."""
    return F.length(F.regexp_replace(text, f"[{complement}]+", ""))


def spaces_to_blank(text: Column) -> Column:
    """Every Python whitespace character -> ' ' (``translate``: no regex)."""
    ws = ws_chars()
    return F.translate(text, ws, " " * len(ws))


def words_of(blanked: Column) -> Column:
    """Words of ``str.split()`` from the blank-normalised text: a literal one-character split (no regex
    compilation per row) without the empty strings between repeated blanks."""
    return F.array_remove(F.split(blanked, " "), "")


def word_count(text: Column) -> Column:
    """number of words of Python's ``str.split()`` (maximal runs of non-space characters)."""
    return F.size(words_of(spaces_to_blank(text)))


def digit_count(text: Column) -> Column:
    """``str.isdigit`` characters, counted by deleting them with ``translate``."""
    return F.length(text) - F.length(F.translate(text, digit_chars(), ""))


def text_stat_columns(text: Column, blanked: Column | None = None, words: Column | None = None,
                      digits: Column | None = None) -> list[Column]:
    """F05-F09, F11 as six aliased columns. NULL/empty text gives zeros.

    ``blanked`` / ``words`` / ``digits`` may be passed in when computed once for several features."""
    t = clean_text(text)
    b = blanked if blanked is not None else spaces_to_blank(t)
    w = words if words is not None else words_of(b)
    n = F.length(t).cast("long")
    n_words = F.size(w).cast("long")
    non_space = F.length(F.replace(b, F.lit(" "), F.lit("")))
    letters = count_runs_complement(t, r"^\p{L}")
    upper = count_runs_complement(t, r"^\p{Lu}")
    d = digits if digits is not None else digit_count(t)
    return [
        n.alias("text_length"),
        n_words.alias("word_count"),
        d.cast("long").alias("digit_count"),
        F.length(F.regexp_replace(b, r"[\p{L}\p{N} ]+", "")).cast("long").alias("special_char_count"),
        F.when(letters > 0, upper.cast("double") / letters).otherwise(F.lit(0.0)).alias("uppercase_ratio"),
        F.when(n_words > 0, non_space.cast("double") / n_words).otherwise(F.lit(0.0)).alias("avg_word_length"),
    ]


def uppercase_share_of_all(text: Column) -> Column:
    """F10 (plan variant): upper-case letters over all characters, at least 1."""
    t = clean_text(text)
    return count_class(t, UPPER_CLASS).cast("double") / F.greatest(F.length(t), F.lit(1))


def keyword_count(lowered: Column, keywords: list[str]) -> Column:
    """how many of the keywords occur as substrings."""
    total = None
    for kw in keywords:
        term = F.when(F.contains(lowered, F.lit(kw)), F.lit(1)).otherwise(F.lit(0))
        total = term if total is None else total + term
    return F.coalesce(total, F.lit(0)).cast("long")


def keyword_columns(lowered: Column) -> list[Column]:
    q = keyword_count(lowered, C.QUALITY_KEYWORDS)
    d = keyword_count(lowered, C.DISCOUNT_KEYWORDS)
    return [
        (q > 0).alias("has_quality_keywords"),
        q.alias("quality_keyword_count"),
        (d > 0).alias("has_discount_keywords"),
        d.alias("discount_keyword_count"),
    ]


def first_words(text: Column, k: int = 5) -> Column:
    """The first ``k`` words of ``str.split()`` without splitting the whole text.

    ``split`` with a limit leaves the rest of the text in the last element, so the array is at most
    ``k + 1`` long whatever the text length; only a trailing element can be empty.
    """
    trimmed = F.ltrim(text, F.lit(ws_chars()))
    return F.slice(F.split(trimmed, f"{ws_class()}+", k + 1), 1, k)


BRAND_WORD_RX = r"^[A-Z]([A-Z]+|[a-z]+)$"


def brand_columns(text: Column, n_words: Column, words: Column | None = None) -> list[Column]:
    """in the first five words, the first whose ASCII letters (more than one) are all capitals or
    Capitalised; the raw word and its position (index / word count). ``words``: the word array if
    already computed (only its first five elements are used)."""
    words = F.slice(words, 1, 5) if words is not None else first_words(text)
    tagged = F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    hits = F.filter(tagged, lambda x: F.regexp_replace(x["w"], "[^a-zA-Z]", "").rlike(BRAND_WORD_RX))
    first = F.try_element_at(hits, F.lit(1))
    ok = first.isNotNull() & (F.coalesce(n_words, F.lit(0)) > 0)
    return [
        F.coalesce(ok, F.lit(False)).alias("has_brand"),
        F.when(ok, first["i"].cast("double") / n_words).alias("brand_position"),
        F.when(ok, first["w"]).alias("potential_brand"),
    ]


def brand_plan_columns(text: Column) -> list[Column]:
    """F15 (plan variant): first word if capitalised and longer than 2 characters (position 0);
    else the first run of Capitalised words, else a possessive ``Xxx's``; position by character
    offset / length; -1 and '' when absent."""
    t = text
    w1 = F.try_element_at(first_words(t, 1), F.lit(1))
    first_ok = w1.isNotNull() & (F.length(w1) > 2) & (F.substring(w1, 1, 1).rlike(r"^\p{Lu}$"))
    caps = F.regexp_extract(t, r"\b([A-Z][a-z]+(?:\s+[A-Z][a-z]+)*)\b", 1)
    poss = F.regexp_extract(t, r"([A-Z][a-z]+'s)", 1)
    found = F.when(caps != "", caps).when(poss != "", poss)
    pos = (F.position(found, t) - 1).cast("double") / F.greatest(F.length(t), F.lit(1))
    has = t.isNotNull() & (first_ok | found.isNotNull())
    return [
        F.coalesce(has, F.lit(False)).alias("has_brand"),
        F.when(t.isNull(), F.lit(-1.0)).when(first_ok, F.lit(0.0)).when(found.isNotNull(), pos)
        .otherwise(F.lit(-1.0)).alias("brand_position"),
        F.when(t.isNull(), F.lit("")).when(first_ok, w1).otherwise(F.coalesce(found, F.lit(""))).alias("potential_brand"),
    ]
