"""Word pairs of a corpus and word counts without them (A8).

Adjacent words of a text are a pair.  Its log-likelihood ratio (Dunning 1993)
compares how often its second word follows its first with how often the second
occurs at all; pairs above ``PAIR_SCORE`` are shown as one, and their
occurrences are taken off the counts of their two words, as a word cloud does.

Counts of words and pairs combine map-side; afterwards only distinct words and
pairs meet, so a word that every text has is one row.

Defined results: pairs don't cross texts; a pair of equal words takes its
count off that word twice; words left with nothing are not shown.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.functions import segment
from corpuslens.session import cut_lineage

# The usual threshold of a word cloud, and the digits that
# scores keep so that it decides alike in every engine.
PAIR_SCORE = 30.0
DIGITS = 6
LEAST = 1e-10


def word_counts(docs: DataFrame, text_col: str) -> DataFrame:
    return docs.select(F.explode(segment.words(text_col)).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def pair_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """(w1, w2, n) of adjacent words."""
    w = docs.select(segment.words(text_col).alias("w")).where(F.size("w") > 1)
    pairs = F.transform(F.slice("w", F.lit(1), F.size("w") - 1), lambda x, i: F.struct(x.alias("w1"), F.get("w", i + 1).alias("w2")))
    return w.select(F.inline(pairs)).groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n"))


def _likelihood(k, n, p):
    return k * F.log(F.greatest(p, F.lit(LEAST))) + (n - k) * F.log(F.greatest(1 - p, F.lit(LEAST)))


def pair_scores(words: DataFrame, pairs: DataFrame) -> DataFrame:
    """(w1, w2, n, n1, n2, score) from (checkpointed) counts."""
    total = words.agg(F.sum("n").cast("double")).scalar()
    met = (pairs.join(words.select(F.col("word").alias("w1"), F.col("n").alias("n1")), "w1")
           .join(words.select(F.col("word").alias("w2"), F.col("n").alias("n2")), "w2").withColumn("_t", total))
    k, a, b, t = (F.col(c).cast("double") for c in ("n", "n1", "n2", "_t"))
    p, p1 = b / t, k / a
    p2 = F.coalesce(F.try_divide(b - k, t - a), F.lit(0.0))
    ratio = 2 * (_likelihood(k, a, p1) + _likelihood(b - k, t - a, p2) - _likelihood(k, a, p) - _likelihood(b - k, t - a, p))
    return met.select("w1", "w2", "n", "n1", "n2", F.round(ratio, DIGITS).alias("score"))


def frequencies(docs: DataFrame, text_col: str, least_score: float = PAIR_SCORE) -> DataFrame:
    """(word, count, pair): chosen pairs as one word, and what is left of the words."""
    words, pairs = cut_lineage(word_counts(docs, text_col)), cut_lineage(pair_counts(docs, text_col))
    chosen = cut_lineage(pair_scores(words, pairs).where(F.col("score") > least_score).select("w1", "w2", "n"))
    taken = (chosen.select(F.explode(F.array("w1", "w2")).alias("word"), "n").groupBy("word").agg(F.sum("n").alias("t")))
    left = words.join(taken, "word", "left").select("word", (F.col("n") - F.coalesce("t", F.lit(0))).alias("count"), F.lit(False).alias("pair"))
    return left.where("count > 0").unionByName(chosen.select(F.concat_ws(" ", "w1", "w2").alias("word"), F.col("n").alias("count"),
                                                             F.lit(True).alias("pair")))
