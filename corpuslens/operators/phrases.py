r"""Phrase ranking and phrase-vector summaries of single documents (T6).

Next to the sum of word ranks (``textrank``), a document's candidates may be
chosen by its phrases:

* a phrase is a run of words of three letters or more with one space between
  them (shorter words, marks and the caller's stop words end it), in pieces of
  at most ``PHRASE_WORDS`` words;
* its rank is sqrt(sum of its words' ranks / number of words), the words
  ranked by PageRank over the co-occurrence graph of ``textrank``;
* the ``PHRASES`` best ones (rank, then phrase) make a vector of unit sum; a
  sentence's distance is the length of the vector of those that it lacks, and
  the nearest sentences (then the first) are kept, whatever their number of
  words.

A document's graph and phrases are bounded by its own length, so they are
worked out in its row, in Arrow batches, without a shuffle.

Defined results: blank and null texts have neither phrases nor sentences; if
no phrase has a rank, all distances are 0; a document with at most ``limit``
sentences keeps all, in order of distance.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.operators import textrank
from corpuslens.operators.extract import guarded_sentences
from corpuslens.options import CANDIDATE_LIMIT
from corpuslens.session import bounded_batches

# Parameters of the definition.
RUN = r"\p{L}{3,}+(?: \p{L}{3,}+)*+"  # possessive: a long run needs no recursion
PHRASE_WORDS, PHRASES = 4, 10
DIGITS = 9
#: words of a caller's stop list, which every task holds
STOP_WORDS = 100_000


def phrases_of(run: str, stop: frozenset) -> list[str]:
    """The phrases of one run of words."""
    out, held = [], []
    for w in run.split(" "):
        if w in stop:
            out, held = out + [held], []
        else:
            held.append(w)
    return [" ".join(part[i:i + PHRASE_WORDS]) for part in [*out, held] for i in range(0, len(part), PHRASE_WORDS)]


def rank_phrases(sentences: list[list[str]], stop: frozenset = frozenset(), top: int = PHRASES):
    """``sentences`` as runs of words -> the best (phrase, rank) and every
    sentence's distance."""
    found = [[p for run in runs for p in phrases_of(run, stop)] for runs in sentences]
    words = [w for s in found for p in s for w in p.split(" ")]
    names, ranks = textrank._graph_ranks(words, textrank.LOOKBACK, textrank.ITERATIONS, textrank.DAMPING)
    rank_of = dict(zip(names, ranks))
    scores = {p: round(float(np.sqrt(sum(rank_of.get(w, 0.0) for w in p.split(" ")) / (p.count(" ") + 1))), DIGITS)
              for s in found for p in s}
    best = sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:top]
    total = sum(r for _, r in best) or 1.0
    unit = {p: r / total for p, r in best}
    away = [round(float(np.sqrt(sum(u * u for p, u in unit.items() if p not in set(s)))), DIGITS) for s in found]
    return best, away


def _stop_set(stop: DataFrame | None) -> frozenset:
    if stop is None:
        return frozenset()
    words = stop.select("word").limit(STOP_WORDS + 1).collect()
    if len(words) > STOP_WORDS:
        raise ValueError(f"a stop list has at most {STOP_WORDS} words")
    return frozenset(r[0] for r in words)


def phrase_ranked(docs: DataFrame, key: str, text_col: str, stop: DataFrame | None = None,
                  top: int = PHRASES) -> DataFrame:
    """(key, phrases array<struct<phrase, rank>>, distances array<double>),
    best phrase first, distances by sentence."""
    bounded_batches(docs.sparkSession)
    listed = _stop_set(stop)
    runs = F.transform(guarded_sentences(text_col), lambda s: F.regexp_extract_all(F.lower(s), F.lit(RUN), F.lit(0)))
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for pdf in batches:
            rows = [rank_phrases([list(r) for r in sents], listed, top) for sents in pdf["runs"]]
            yield pd.DataFrame({key: pdf[key], "phrases": [[{"phrase": p, "rank": r} for p, r in best] for best, _ in rows],
                                "distances": [away for _, away in rows]})

    return docs.select(key, runs.alias("runs")).mapInPandas(
        run, f"{key} {kind}, phrases array<struct<phrase:string,rank:double>>, distances array<double>")


def nearest_sentences(ranked: DataFrame, key: str, limit: int = CANDIDATE_LIMIT) -> DataFrame:
    """(key, place, pos, distance): the ``limit`` sentences nearest to the
    document's phrase vector, places and positions from 1."""
    order = F.array_sort(F.transform("distances", lambda d, i: F.struct(d.alias("distance"), (i + 1).alias("pos"))))
    rows = ranked.select(key, F.posexplode(F.slice(order, 1, limit)).alias("_p", "s"))
    return rows.select(key, (F.col("_p") + 1).cast("bigint").alias("place"), F.col("s.pos").cast("bigint").alias("pos"),
                       F.col("s.distance").alias("distance"))
