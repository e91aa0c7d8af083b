"""TextRank kernel vs the join-based PageRank, and job options."""

import pytest

from corpuslens.operators import textrank as TR
from corpuslens.options import Variant, variant_name


def test_kernel_equals_join_pagerank(spark):
    docs = spark.createDataFrame([
        (1, "alpha beta gamma alpha delta beta gamma epsilon alpha beta"),
        (2, "one two three four five six seven eight nine ten one two"),
        (3, "lonely"),
    ], "doc_id long, text string")
    stop = spark.createDataFrame([("six",)], "word string")
    kernel = {(r.doc_id, r.word): r.rank for r in TR.doc_word_ranks(docs, "doc_id", "text", stop).collect()}
    edges = TR.cooccurrence_edges(docs, "doc_id", "text", stop)
    joined = {(r.doc_id, r.word): r.rank for r in TR.word_pagerank(edges, "doc_id").collect()}
    assert kernel.keys() == joined.keys()
    for k in kernel:
        assert kernel[k] == pytest.approx(joined[k], rel=1e-12)
    for d in (1, 2):
        assert sum(v for (doc, _), v in kernel.items() if doc == d) == pytest.approx(1.0)


def test_candidate_limit(spark):
    from corpuslens.operators import extract

    sents = [f"word{i % 7} filler{i} text." for i in range(100)]
    docs = spark.createDataFrame([(1, " ".join(sents))], "doc_id long, text string")
    capped = extract.ranked_sentences(docs, "doc_id", "text", 80).collect()
    assert len(capped) == 80 and len({r.pos for r in capped}) == 80
    every = [extract.ranked_sentences(docs, "doc_id", "text", limit).collect() for limit in (None, 100, 5000)]
    assert len(every[0]) == 100 and every[0] == every[1] == every[2]


def test_a_term_of_every_document_is_divided(spark):
    """AQE splits the partition of a term that all documents have."""
    from corpuslens.operators import vectors

    docs = spark.range(60_000).selectExpr("id as doc_id", "concat('common w', id) as text")
    held = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",)}
    small = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k"}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        idf = vectors.idf_table(docs, "doc_id", "text")
        joined = vectors.distinct_terms(docs, "doc_id", "text").join(idf, "term")
        assert joined.count() == 120_000
        out = joined.groupBy("doc_id").count()
        out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in small:
            spark.conf.unset(k)
        for k, v in held.items():
            spark.conf.set(k, v)


def test_variant_rules():
    for wrong in ({"part": "abstract", "ranked": True}, {"abstract_first": True}, {"part": "body"}, {"part": "x"}):
        with pytest.raises(ValueError):
            Variant(**wrong)
    with pytest.raises(ValueError):
        Variant(ranked=True).suffixes()


def test_variant_names():
    assert variant_name("elife", "train", Variant()) == "elife_train"
    assert variant_name("elife", "train", Variant("abstract", cleaned=True)) == "elife_train_abstract_only_preprocessed"
    assert variant_name("plos", "test", Variant("body", ranked=True, abstract_first=True, cleaned=True), 20) == \
        "plos_test_extractive_20_exclude_abstract_concat_abstract_preprocessed"


def test_pluggable_dense_encoder(spark):
    import numpy as np

    from corpuslens.operators import vectors

    def encode(texts):  # a stand-in model: letter histogram per text
        out = []
        for t in texts:
            v = np.zeros(26, dtype=np.float32)
            for ch in t.lower():
                if "a" <= ch <= "z":
                    v[ord(ch) - 97] += 1
            out.append(v.tolist())
        return out

    enc = vectors.pandas_encoder(encode)
    df = spark.createDataFrame([(1, "abc abc", "abc"), (2, "xyz", "abc"), (3, "", "abc")],
                               "id int, s string, d string")
    got = {r.id: r.c for r in df.select("id", vectors.dense_cosine(enc("s"), enc("d")).alias("c")).collect()}
    assert got[1] == pytest.approx(1.0) and got[2] == pytest.approx(0.0) and got[3] is None


def test_edges_are_counted_in_the_row(spark):
    """Distinct keys need no exchange of edges; repeated and null ones add up."""
    from collections import Counter

    rows = [(1, "alpha beta alpha gamma"), (2, "beta alpha delta"), (3, None), (4, "solo solo")]
    def want(rows):
        out = Counter()
        for k, t in rows:
            w = (t or "").split()
            for i in range(len(w)):
                for d in (1, 2, 3):
                    if i + d < len(w) and w[i] != w[i + d]:
                        out.update([(k, w[i], w[i + d]), (k, w[i + d], w[i])])
        return out

    for more in ([], [(1, "beta alpha"), (None, "alpha beta"), (None, "beta alpha gamma")]):
        docs = spark.createDataFrame(rows + more, "doc_id long, text string")
        edges = TR.cooccurrence_edges(docs, "doc_id", "text")
        assert {(r.doc_id, r.a, r.b): r.weight for r in edges.collect()} == want(rows + more)
        if not more:
            assert "Exchange" not in edges._jdf.queryExecution().executedPlan().toString()


def test_graphs_in_one_row_equal_the_joins(spark, monkeypatch):
    """Graphs whose edges lie together shuffle none; scattered, large, one-way
    and repeated ones, null keys and words give what the joins give."""
    whole = [(k, x, y, w) for k in (1, 2, 3) for a, b, w in [("p", "q", 2), ("q", "r", k), ("p", "s", 1)]
             for x, y in ((a, b), (b, a))]
    odd = [(4, "p", "q", 1), (4, "q", "r", 2), (None, "p", "q", 1), (None, "q", "p", 1), (5, None, "q", 1), (5, "q", "p", 3),
           (5, "p", "q", 1), (1, "q", "t", 1), (1, "t", "q", 1)]
    def got(df):
        return sorted((r.k, r.word, round(r["rank"], 12)) for r in df.collect())

    for rows, least in ((whole, 200_000), (whole + odd, 200_000), (whole + odd, 2)):
        monkeypatch.setattr(TR, "EDGES_PER_ROW", least)
        monkeypatch.setattr(TR, "EDGES_AT_ONCE", min(least, 100_000))
        edges = spark.createDataFrame(rows, "k long, a string, b string, weight long").coalesce(1)
        ranks = TR.word_pagerank(edges, "k")
        assert got(ranks) == got(TR._joined_pagerank(edges, "k", TR.ITERATIONS, TR.DAMPING))
        if rows is whole:
            assert "Exchange" not in ranks._jdf.queryExecution().executedPlan().toString()


def test_weights_of_frequent_terms_are_sent(spark, monkeypatch):
    """A ranking is the same whether a term's weight is sent or joined; if all
    are sent, no text is shuffled."""
    from corpuslens.operators import extract, vectors

    rows = [(1, "Red blue red. Green sky! Blue."), (2, "red sun. Odd words here? Red blue."), (2, "Sun sun. Rain."),
            (None, "red. blue sky."), (3, ""), (4, None), (5, "1 2. 3!")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = []
    for most in (1 << 18, 3, 0):
        monkeypatch.setattr(vectors, "FREQUENT", most)
        scored = extract.scored_documents(docs, "doc_id", "text", 2)
        plan = scored._jdf.queryExecution().executedPlan().toString()
        assert ("Exchange" in plan) == (most < 1000)
        got.append(sorted((str(r.doc_id), str(r.sents), r.keep, [x and round(x, 12) for x in r.cos]) for r in scored.collect()))
    assert got[0] == got[1] == got[2]
    assert [r[3] for r in got[0] if r[0] == "None"] == [[None, None]]


def test_repeated_pairs_are_counted_once_each(spark):
    from corpuslens.operators import overlap

    rows = [(i, *p) for i, p in enumerate([("a b a", "a b"), ("a b a", "a b"), ("a b a", "a c"), (None, "a c"), (None, "a c"),
                                           ("", "a c"), ("a b a", "a b")])]
    pairs = spark.createDataFrame(rows, "k int, g string, r string").coalesce(1)
    got = {(r.k, r.n): (r.matched, r.gen_total, r.ref_total) for r in overlap.ngram_overlap(pairs, "k", "g", "r").collect()}
    assert [got[i, 1] for i in range(7)] == [(2, 3, 2), (2, 3, 2), (1, 3, 2), (0, 0, 2), (0, 0, 2), (0, 0, 2), (2, 3, 2)]
    assert [got[i, 2][0] for i in range(7)] == [1, 1, 0, 0, 0, 0, 1]


def test_terms_of_one_frequency_need_no_join(spark, monkeypatch):
    """If all terms beyond those sent are in equally many documents, their
    weight is known and no text is shuffled."""
    from corpuslens.operators import extract, vectors

    rows = [(1, "Red blue red. Green sky! Blue."), (2, "red sun. Odd words here? Red blue."), (2, "Sun sun. Rain."), (3, "red. blue sky.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = []
    for most in (1 << 18, 4, 3):
        monkeypatch.setattr(vectors, "FREQUENT", most)
        scored = extract.scored_documents(docs, "doc_id", "text", 2)
        assert ("Exchange" in scored._jdf.queryExecution().executedPlan().toString()) == (most == 3)
        got.append(sorted((str(r.sents), r.keep, [x and round(x, 12) for x in r.cos]) for r in scored.collect()))
    assert got[0] == got[1] == got[2]


def test_document_frequencies_are_added_up(spark, monkeypatch):
    from corpuslens.operators import vectors

    monkeypatch.setattr(vectors, "COUNTS_HELD", 3)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["a b a", "b C", None, "", "c a. d", "É é a"])], "k long, t string").coalesce(1)
    got = vectors.document_frequencies(docs, "t").groupBy("term").sum("n").collect()
    assert {r[0]: r[1] for r in got} == {"a": 3, "b": 2, "c": 2, "d": 1, "é": 1} and len(got) == 5


def test_ranks_of_documents_in_small_parts(spark, monkeypatch):
    """Documents ranked together give what each gives alone."""
    texts = ["alpha beta gamma alpha delta beta", "solo", "", None, "one two one two three", "solo solo", "alpha one", None]
    docs = spark.createDataFrame([(i if i else None, t) for i, t in enumerate(texts)], "k long, t string").coalesce(1)
    got = []
    for most in (100_000, 4):
        monkeypatch.setattr(TR, "WORDS_AT_ONCE", most)
        got.append(sorted((str(r.k), r.word, round(r["rank"], 12)) for r in TR.doc_word_ranks(docs, "k", "t").collect()))
    alone = [(str(i if i else None), w, round(r, 12)) for i, t in enumerate(texts)
             for w, r in zip(*TR._graph_ranks((t or "").split(), TR.LOOKBACK, TR.ITERATIONS, TR.DAMPING))]
    assert got[0] == got[1] == sorted(alone)
    assert "MapInArrow" in TR.doc_word_ranks(docs, "k", "t")._jdf.queryExecution().executedPlan().toString()


def test_a_comparison_evaluates_the_corpus_once(spark):
    """The report is a row per method; its sides are read, not computed again."""
    from corpuslens.plans import catalog

    for name in ("metric_intersect", "pairwise_wins", "pairwise_long", "metric_bars"):
        plan = catalog.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "ArrowEvalPython" not in plan and "MapInArrow" not in plan
