import pytest

from corpuslens.operators import phrases as P


def test_runs_are_cut_at_short_words_stop_words_and_length():
    assert P.phrases_of("red green blue", frozenset()) == ["red green blue"]
    assert P.phrases_of("red green blue white black", frozenset()) == ["red green blue white", "black"]
    assert P.phrases_of("red the green the", frozenset({"the"})) == ["red", "green"]


def test_phrase_ranks_and_distances_by_hand():
    best, away = P.rank_phrases([["big cat", "old dog"], ["old dog"], [], ["big cat"]])
    # four words in one cycle-like graph: equal ranks by symmetry of the two phrases
    assert {p for p, _ in best} == {"big cat", "old dog"}
    total = sum(r for _, r in best)
    unit = {p: r / total for p, r in best}
    assert away[0] == 0
    assert away[1] == pytest.approx(unit["big cat"], abs=1e-9) and away[3] == pytest.approx(unit["old dog"], abs=1e-9)
    assert away[2] == pytest.approx((unit["big cat"] ** 2 + unit["old dog"] ** 2) ** 0.5, abs=1e-9)


def test_one_word_has_no_graph():
    assert P.rank_phrases([["word"]]) == ([("word", 0.0)], [0.0])
    assert P.rank_phrases([]) == ([], [])


def test_documents(spark):
    rows = [(1, "Heavy metal music is loud. Heavy metal music sells. A cat sat."), (2, None), (3, " \n"), (4, "of to in")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in P.phrase_ranked(docs, "doc_id", "text").collect()}
    assert got[2].phrases == got[3].phrases == [] and got[2].distances == [] and got[4].distances == [0.0]
    assert len(got[1].distances) == 3 and {p.phrase for p in got[1].phrases} >= {"heavy metal music", "loud", "cat sat"}
    near = P.nearest_sentences(P.phrase_ranked(docs, "doc_id", "text"), "doc_id", 2).collect()
    assert [(r.doc_id, r.place) for r in sorted(near)] == [(1, 1), (1, 2), (4, 1)]
    stop = spark.createDataFrame([("music",), ("heavy",)], "word string")
    stopped = {r.doc_id: r for r in P.phrase_ranked(docs, "doc_id", "text", stop).collect()}
    assert "metal" in {p.phrase for p in stopped[1].phrases}
    assert P.phrase_ranked(docs.limit(0), "doc_id", "text").collect() == []
    plan = P.phrase_ranked(docs, "doc_id", "text")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1  # the fixture's own repartition
