"""Cleaning and tokenising of review text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns that decide what counts as a word. (?U) makes \b treat accented
# letters as part of a word on every JVM that Spark supports; whitespace stays ASCII.
NUMBER_WITH_UNIT = r"\b\p{N}+\p{L}*\b"
NOT_LETTER_OR_SPACE = r"[^\p{L} \t\n\x0B\f\r]"
TOKEN_DELIMITERS = r'[ \r\n",()*]+'


def clean(text: Column) -> Column:
    """Lower-cased text without numbers, their attached units, or punctuation.

    Punctuation is removed, not replaced by a space, so ``a,b`` becomes ``ab``. Both patterns
    are removed in one pass: neither can match across what the other takes out.
    """
    removed = f"(?U){NUMBER_WITH_UNIT}|{NOT_LETTER_OR_SPACE}"
    return F.regexp_replace(F.lower(text), removed, "")


def words(cleaned: Column) -> Column:
    """Array of tokens; it may hold empty strings at the ends, to be dropped after exploding.

    A record is one line, so line breaks inside a text separate words like spaces do.
    """
    return F.split(cleaned, TOKEN_DELIMITERS, -1)


def without_prefix(text: Column, prefix: str) -> Column:
    """The text after a prefix; null where the text does not start with it."""
    return F.when(text.startswith(prefix), F.substr(text, F.lit(len(prefix) + 1)))
