"""Readability formulas as column expressions.

Counts come from ``segment``: words, sentences, vowel groups (syllables,
floored at one per word) and letters (characters inside words).  A text
without words has no score (null) instead of a division error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.functions import segment

# Published formula coefficients.
FRE_BASE, FRE_WPS, FRE_SPW = 206.835, 1.015, 84.6
FKGL_WPS, FKGL_SPW, FKGL_BASE = 0.39, 11.8, 15.59
CLI_L, CLI_S, CLI_BASE = 0.0588, 0.296, 15.8
DCRS_PDW, DCRS_WPS, DCRS_ADJ, DCRS_THRESHOLD = 0.1579, 0.0496, 3.6365, 5.0


def with_counts(df: DataFrame, text_col: str, prefix: str = "") -> DataFrame:
    """Add ``{prefix}n_words``, ``n_sents``, ``n_syll``, ``n_letters`` (bigint)."""
    w = segment.words(text_col)
    out = df.withColumn(f"{prefix}_w_arr", w)
    return (out
            .withColumn(f"{prefix}n_words", F.size(f"{prefix}_w_arr").cast("bigint"))
            .withColumn(f"{prefix}n_sents", F.size(segment.sentences(text_col)).cast("bigint"))
            .withColumn(f"{prefix}n_syll",
                        F.greatest(segment.vowel_groups(text_col).cast("bigint"),
                                   F.col(f"{prefix}n_words")))
            .withColumn(f"{prefix}n_letters",
                        F.length(F.array_join(f"{prefix}_w_arr", "")).cast("bigint"))
            .drop(f"{prefix}_w_arr"))


def _ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def flesch_reading_ease(n_words, n_sents, n_syll) -> Column:
    w, s, y = F.col(n_words), F.col(n_sents), F.col(n_syll)
    score = F.lit(FRE_BASE) - F.lit(FRE_WPS) * _ratio(w, s) - F.lit(FRE_SPW) * _ratio(y, w)
    return F.when(w > 0, score)


def flesch_kincaid_grade(n_words, n_sents, n_syll) -> Column:
    w, s, y = F.col(n_words), F.col(n_sents), F.col(n_syll)
    score = F.lit(FKGL_WPS) * _ratio(w, s) + F.lit(FKGL_SPW) * _ratio(y, w) - F.lit(FKGL_BASE)
    return F.when(w > 0, score)


def coleman_liau(n_words, n_sents, n_letters) -> Column:
    w, s, l_ = F.col(n_words), F.col(n_sents), F.col(n_letters)
    letters_per_100 = _ratio(l_, w) * F.lit(100.0)
    sents_per_100 = _ratio(s, w) * F.lit(100.0)
    return F.when(w > 0, F.lit(CLI_L) * letters_per_100 - F.lit(CLI_S) * sents_per_100 - F.lit(CLI_BASE))


def dale_chall(n_words, n_sents, n_difficult) -> Column:
    """New Dale-Chall score from a count of difficult (non-easy) words."""
    w, s, d = F.col(n_words), F.col(n_sents), F.col(n_difficult)
    pct = _ratio(d, w) * F.lit(100.0)
    raw = F.lit(DCRS_PDW) * pct + F.lit(DCRS_WPS) * _ratio(w, s)
    return F.when(w > 0, F.when(pct > F.lit(DCRS_THRESHOLD), raw + F.lit(DCRS_ADJ)).otherwise(raw))


def readability(df: DataFrame, text_col: str) -> DataFrame:
    """Add FRE, FKGL and CLI (plus the counts) for ``text_col``."""
    out = with_counts(df, text_col)
    return out.select(
        "*",
        flesch_reading_ease("n_words", "n_sents", "n_syll").alias("fre"),
        flesch_kincaid_grade("n_words", "n_sents", "n_syll").alias("fkgl"),
        coleman_liau("n_words", "n_sents", "n_letters").alias("cli"),
    )
