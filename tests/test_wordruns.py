"""Words of whole Arrow arrays against the patterns of ``segment``."""

import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpuslens.functions import segment
from corpuslens.functions import wordruns as W
from corpuslens.operators import evaluate, extract, overlap, phrases, textrank

TEXTS = ["", "One two, two ÀÉ×ÿ three! Is it? ", None, "... . \n  \n a", "naïve  漢字かな ab abc Ωμέγα 😀x𝒳𝒴𝒵 İstanbul", "  ! x\n\ny", "ab" * 50,
         "rhythm yes aye\nqueue... end", " ", "a.b.c", "ɏɐ zz zz zz zz"]


def test_counts_equal_the_patterns(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "k int, t string").select(
        F.lower(F.coalesce("t", F.lit(""))).alias("low"), segment.words("t").alias("w"), F.size(segment.sentences("t")).alias("s"),
        segment.vowel_groups("t").alias("v"), textrank.textrank_words("t").alias("tr")).collect()
    for some in (rows, rows[3:5], rows[:1], []):
        points, sizes = W.code_points(pa.array([r.low for r in some], pa.string()))
        found, n, long = W.words(points, sizes, W.latin())
        assert found.to_pylist() == [w for r in some for w in r.w] and n.tolist() == [len(r.w) for r in some]
        assert long.tolist() == [len(w) for r in some for w in r.w]
        assert W.vowel_groups(points, sizes).tolist() == [r.v for r in some]
        assert W.sentences(points, sizes).tolist() == [r.s for r in some]
        tr, n, _ = W.words(points, sizes, W.letters(), textrank.LEAST_LETTERS)
        assert tr.to_pylist() == [w for r in some for w in r.tr] and n.tolist() == [len(r.tr) for r in some]
        assert [set(x) for x in W.distinct(pa.array([r.low for r in some], pa.string())).to_pylist()] == [set(r.w) for r in some]


def test_clipped_matches_equal_counters(spark, monkeypatch):
    monkeypatch.setattr(W, "BLOCK", 40)
    pairs = [(i, a, b) for i, (a, b) in enumerate([("a b a b a b c", "a b a b"), ("a a a", "a"), ("", "x"), ("x", ""), (None, None),
                                                   ("b c a b", "a b c a b c"), ("The the THE", "the The"), ("a b c d e", "e d c b a")])]
    got = {(r.k, r.n): r for r in overlap.ngram_overlap(spark.createDataFrame(pairs, "k int, g string, r string"),
                                                        "k", "g", "r", (1, 2, 3, 4)).collect()}
    for k, g, r in pairs:
        g, r = (re.findall(r"[a-z]+", (x or "").lower()) for x in (g, r))
        for n in (1, 2, 3, 4):
            want = Counter(zip(*(g[i:] for i in range(n)))) & Counter(zip(*(r[i:] for i in range(n))))
            assert (got[k, n].matched, got[k, n].gen_total, got[k, n].ref_total) == (
                want.total(), max(len(g) - n + 1, 0), max(len(r) - n + 1, 0))


def test_a_document_without_a_key_is_scored(spark):
    docs = spark.createDataFrame([(None, "One two. Three."), (1, "One. Two two.")], "doc_id long, text string")
    got = {r.doc_id: r for r in extract.scored_documents(docs, "doc_id", "text", 1).collect()}
    assert got[None].cos == [None, None] and len(got[1].cos) == 2 and len(got[None].keep) == len(got[1].keep) == 1


@pytest.mark.parametrize("work", ["eval", "scores", "ranks", "phrases"])
def test_batches_are_bounded(spark, work):
    """What a worker holds must not grow with the rows of a partition."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    docs = spark.createDataFrame([(1, "a b. c d.", "m")], "doc_id long, text string, model string")
    spark.conf.unset(setting)
    {"eval": lambda: evaluate.doc_metrics(docs.withColumn("r", F.col("text")), evaluate.word_list(docs), "doc_id", "text", "r"),
     "scores": lambda: extract.scored_documents(docs, "doc_id", "text", None),
     "ranks": lambda: textrank.doc_word_ranks(docs, "doc_id", "text"),
     "phrases": lambda: phrases.phrase_ranked(docs, "doc_id", "text")}[work]()
    assert 0 < int(spark.conf.get(setting)) <= 500


def test_numbers_tell_words_apart():
    a, b = "a", "b"
    for _ in range(11):  # words that a sum of powers of any odd number can't tell apart
        a, b = a + b, b + a
    texts = [*(t or "" for t in TEXTS), a, b, f"{a} {b}", "ab", "ba", "ab ba a b aa"]
    texts = [t.lower() for t in texts]
    points, sizes = W.code_points(pa.array(texts))
    found, n, _ = W.words(points, sizes, W.latin())
    for seed in (0, 1):
        numbers, m = W.word_numbers(points, sizes, W.latin(), seed)
        assert m.tolist() == n.tolist() and len(set(numbers.tolist())) == len(set(found.to_pylist()))
        assert len(set(zip(numbers.tolist(), found.to_pylist()))) == len(set(found.to_pylist()))
