"""Sentence, word, token and n-gram expressions (Column -> Column).

Definitions are regex based so Spark and a SQL oracle agree exactly:

* sentence: a run of characters other than ``. ! ? \\n`` followed by any
  run of ``. ! ?``, trimmed of spaces; empty pieces dropped.
* word: a lower-cased run of Latin letters ``[A-Za-zÀ-ɏ]``.
* token (punctuation-inclusive): a letter run, a digit run, or one
  character that is neither space, letter nor digit.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The segmentation patterns shared with the SQL oracle.
SENTENCE_PATTERN = r"[^.!?\n]+[.!?]*"
FIRST_SENTENCE_PATTERN = r"^(?:[.!?\n]| +(?=\n|\z))*+([^.!?\n]+[.!?]*)"
WORD_PATTERN = r"[A-Za-zÀ-ɏ]+"
TOKEN_PATTERN = r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]"
VOWEL_GROUP_PATTERN = r"[aeiouy]+"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def sentences(col) -> Column:
    """array<string> of the sentences of a text (null text -> empty array)."""
    raw = F.regexp_extract_all(F.coalesce(_c(col), F.lit("")), F.lit(SENTENCE_PATTERN), 0)
    return F.filter(F.transform(raw, lambda s: F.trim(s)), lambda s: s != F.lit(""))


def first_sentence(col) -> Column:
    """The first of ``sentences``, found without splitting the rest (or null)."""
    found = F.regexp_extract(F.coalesce(_c(col), F.lit("")), FIRST_SENTENCE_PATTERN, 1)
    return F.nullif(F.trim(found), F.lit(""))


def words(col) -> Column:
    """array<string> of lower-cased words."""
    return F.regexp_extract_all(F.lower(F.coalesce(_c(col), F.lit(""))), F.lit(WORD_PATTERN), 0)


def tokens(col) -> Column:
    """array<string> of punctuation-inclusive tokens."""
    return F.regexp_extract_all(F.coalesce(_c(col), F.lit("")), F.lit(TOKEN_PATTERN), 0)


def vowel_groups(col) -> Column:
    """Number of vowel groups in the lower-cased text."""
    return F.size(F.regexp_extract_all(F.lower(F.coalesce(_c(col), F.lit(""))),
                                       F.lit(VOWEL_GROUP_PATTERN), 0))


def ngrams(words_col, n: int) -> Column:
    """array<string> of space-joined n-grams of a word array."""
    w = _c(words_col)
    return F.when(
        F.size(w) >= n,
        F.transform(F.sequence(F.lit(0), F.size(w) - n),
                    lambda i: F.array_join(F.slice(w, i + 1, n), " ")),
    ).otherwise(F.array().cast("array<string>"))

