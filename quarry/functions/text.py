"""Text column functions (F1-F10, N1, N2 building blocks).

Java regex ``\\w`` is ASCII-only while Python's is Unicode; we spell word
characters as ``[\\p{L}\\p{N}_]`` so the result is the same in Spark, DuckDB
and Python.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.functions.predicates import col_

__all__ = [
    "WORD", "PUNCTUATION", "remove_urls", "remove_mentions", "strip_punctuation",
    "remove_digits", "collapse_whitespace", "clean_text", "char_length",
    "word_count", "preview", "field",
]

WORD = r"[\p{L}\p{N}_]"
# Fixed value: the 32 ASCII punctuation marks (Python string.punctuation).
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

URL_RE = r"http\S+|www\S+"
MENTION_RE = "@" + WORD + "+|#" + WORD + "+"


def remove_urls(c) -> Column:
    return F.regexp_replace(col_(c), URL_RE, "")


def remove_mentions(c) -> Column:
    return F.regexp_replace(col_(c), MENTION_RE, "")


def strip_punctuation(c) -> Column:
    return F.translate(col_(c), PUNCTUATION, "")


def remove_digits(c) -> Column:
    return F.regexp_replace(col_(c), r"\d+", "")


def collapse_whitespace(c) -> Column:
    return F.trim(F.regexp_replace(col_(c), r"\s+", " "))


def clean_text(c) -> Column:
    """Lower -> URLs -> mentions/hashtags -> punctuation -> digits -> spaces."""
    t = F.lower(col_(c))
    t = remove_urls(t)
    t = remove_mentions(t)
    t = strip_punctuation(t)
    t = remove_digits(t)
    return collapse_whitespace(t)


def char_length(c) -> Column:
    """characters (code points)."""
    return F.length(col_(c)).cast("bigint")


def word_count(c) -> Column:
    """whitespace-separated words (empty / blank text -> 0)."""
    parts = F.split(F.trim(col_(c)), r"\s+")
    return F.size(F.filter(parts, lambda x: x != F.lit(""))).cast("bigint")


def preview(c, n: int = 300) -> Column:
    """first ``n`` characters plus ``...`` when longer."""
    c = col_(c)
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


def field(c, sep: str, i: int) -> Column:
    """zero-based field ``i`` of a delimited string (null when absent)."""
    import re as _re
    return F.get(F.split(col_(c), _re.escape(sep)), i)
