"""String expressions with the exact white space, title-case and counting rules that the operators need."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's str.strip and str.split see it, as a Java character class body.
SPACE = r"\s\x1c-\x1f\x85\p{Z}"
#: Word characters as Python's \w sees them: letters, digits and other numbers, underscore.
WORD = r"\p{L}\p{N}_"


def strip(s: Column) -> Column:
    """s without white space, of any kind, at both ends."""
    return F.regexp_replace(s, rf"^[{SPACE}]+|[{SPACE}]+$", "")


def rstrip(s: Column) -> Column:
    return F.regexp_replace(s, rf"[{SPACE}]+$", "")


def words(s: Column) -> Column:
    """The words of s; none for an empty text."""
    return F.filter(F.split(s, rf"[{SPACE}]+"), lambda w: w != "")


def word_count(s: Column) -> Column:
    return F.size(words(s))


def tokens_of(n_words: Column) -> Column:
    """The token estimate of so many words: three quarters of a word to a token, one at least."""
    return F.greatest(F.lit(1), F.floor(n_words / F.lit(0.75)).cast("int"))


def count_tokens(s: Column) -> Column:
    return tokens_of(word_count(s))


def last_words(ws: Column, n: int) -> Column:
    """The last n words of an array, joined by single spaces; all of it where it has no more."""
    return F.array_join(F.slice(ws, F.greatest(F.lit(1), F.size(ws) - n + 1), F.lit(n)), " ")


def title_case(s: Column) -> Column:
    """Capitals after every character that is not a letter, small letters elsewhere."""
    parts = F.regexp_extract_all(s, F.lit(r"(\p{L}+|[^\p{L}]+)"), 1)
    return F.array_join(F.transform(parts, F.initcap), "")


_LINK_ONLY = re.compile(r"^\s*\[([^\]]{1,60})\]\([^)]+\)\s*$", re.M)


def clean_lines(md: str) -> str:
    """Blank lines collapsed, then lines that hold one short link only removed, then trailing white space."""
    md = _LINK_ONLY.sub("", re.sub(r"\n{3,}", "\n\n", md))
    return "\n".join(x.rstrip() for x in md.splitlines()).strip()


def clean_markdown(md: Column) -> Column:
    """clean_lines() of a column, by an Arrow pass; null stays."""

    def clean(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else clean_lines(t) for t in texts], dtype=object)

    return F.pandas_udf(clean, "string")(md)


def clean_pdf_text(s: Column) -> Column:
    """Ligatures and typographic quotes to plain ones, runs of blanks to one."""
    for old, new in (("\ufb01", "fi"), ("\ufb02", "fl"), ("\u2019", "'"), ("\u201c", '"'), ("\u201d", '"')):
        s = F.replace(s, F.lit(old), F.lit(new))
    return strip(F.regexp_replace(s, r"[ \t]+", " "))


# Frequent words by language, for the optional detector.
STOP_WORDS = {
    "en": "the of and to in is that for it was on are as with be",
    "fr": "le la les des et en un une du que est pour dans qui sur",
    "de": "der die und das den von zu mit sich des auf ist nicht ein eine",
    "es": "el la los de que y en un una por con para las del se",
}


def detect_language(s: Column, detector: str = "constant") -> Column:
    """The language of a text: "en" for all ("constant"), or the one with most stop words among the first 2,000 characters.

    Samples of 20 characters or fewer, and texts without a stop word, are "en".
    """
    if detector == "constant":
        return F.lit("en")
    sample = strip(F.substring(s, 1, 2000))
    ws = words(F.lower(sample))
    score = lambda lang: F.size(F.filter(ws, lambda w: w.isin(STOP_WORDS[lang].split())))
    ranked = F.array_sort(F.array(*(F.struct((-score(k)).alias("n"), F.lit(i).alias("i"), F.lit(k).alias("lang")) for i, k in enumerate(STOP_WORDS))))
    return F.when((F.length(sample) > 20) & (ranked[0]["n"] < 0), ranked[0]["lang"]).otherwise(F.lit("en"))
