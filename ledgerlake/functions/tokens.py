"""Tokenising and sentence splitting with Spark's built-in array functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Everything that is not a Unicode letter separates tokens.
TOKEN_BREAK = r"[^\p{L}]+"
# A sentence runs to its closing mark or the end of the line.
SENTENCE = r"[^.!?\n]+[.!?]?"


def tokens(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), TOKEN_BREAK), "")


def sentences(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(SENTENCE), F.lit(0))


def hits(token_array: Column, words: list[str]) -> Column:
    """Tokens found in a word list; Catalyst turns the long IN list into a hash set."""
    return F.filter(token_array, lambda t: t.isin(words))
