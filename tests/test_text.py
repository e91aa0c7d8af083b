"""Cleaning and segmentation expressions against fixed edge strings."""

import pytest
from pyspark.sql import functions as F

from corpuslens.functions import segment, text

# (input, preprocess_text, remove_cutoff, remove_brackets, postprocess)
EDGE = [
    ("a (b (c) d) [e] {f}. x ,y;z 3.14 and e.g. p=.05 ... ok?!yes",
     "a(b d). x, y; z 3.14 and e. g. p=.05.. . ok? ! yes",
     "a (b (c) d) [e] {f}. x ,y;z 3.14 and e.g. p=.05 ...",
     "a (b  d)  . x ,y;z 3.14 and e.g. p=.05 ... ok?!yes",
     "a (b  d)  . x ,y;z 3.14 and e.g. p=.05 ..."),
    ("no period", "no period", "no period", "no period", "no period"),
    ("", "", "", "", ""),
    ("A.B (x\ny) tail", "A. B tail", "A.", "A.B  tail", "A."),
    ("[a(b]c) (a[b)c]", "", "[a(b]c) (a[b)c]", "c) c]", "c) c]"),
    ("é . è,ç 10% of 5:3", "é. è, ç 10% of 5: 3", "é .", "é . è,ç 10% of 5:3", "é ."),
    ("One. Two (see 3.) thr", "One. Two thr", "One. Two (see 3.", "One. Two  thr", "One. Two (see 3."),
    (" 1,000 mice; p < 0.05 . Next", "1, 000 mice; p<0.05.Next", " 1,000 mice; p < 0.05 .",
     " 1,000 mice; p < 0.05 . Next", " 1,000 mice; p < 0.05 ."),
    ("x (y.", "x(y.", "x (y.", "x (y.", "x (y."),
]


@pytest.fixture(scope="module")
def edge_df(spark):
    return spark.createDataFrame([(i, e[0]) for i, e in enumerate(EDGE)], "id int, t string")


def test_clean_functions_match_fixtures(edge_df):
    out = edge_df.select("id", text.preprocess_text("t").alias("pp"), text.remove_cutoff("t").alias("cut"),
                         text.remove_brackets("t").alias("nb"), text.postprocess("t").alias("post"))
    got = {r.id: (r.pp, r.cut, r.nb, r.post) for r in out.collect()}
    for i, e in enumerate(EDGE):
        assert got[i] == e[1:], (i, e[0])


def test_split_abstract(spark):
    df = spark.createDataFrame([("A\nB\nC",), (" A ",), ("\nB",), (None,)], "t string")
    rows = df.select(text.abstract_of("t").alias("a"), text.body_of("t").alias("b")).collect()
    assert [(r.a, r.b) for r in rows[:3]] == [("A", "B\nC"), ("A", ""), ("", "B")]
    assert rows[3].b == ""


def test_strip_is_python_strip(spark):
    samples = ["  a b \n", "　x ", "\t\t", "plain", "  y  "]
    df = spark.createDataFrame([(s,) for s in samples], "t string")
    assert [r.s for r in df.select(text.strip("t").alias("s")).collect()] == [s.strip() for s in samples]


def test_prepend_abstract_strips(spark):
    df = spark.createDataFrame([("Abs", "s1\ns2"), ("", "s1"), ("Abs", "")], "a string, s string")
    got = [r.x for r in df.select(text.prepend_abstract("a", "s").alias("x")).collect()]
    assert got == ["Abs\ns1\ns2", "s1", "Abs"]


def test_sentences_words_tokens(spark):
    df = spark.createDataFrame([("Hello world. This is... a test!\nNew line? yes",)], "t string")
    r = df.select(segment.sentences("t").alias("s"), segment.words("t").alias("w"),
                  segment.tokens("t").alias("k")).first()
    assert r.s == ["Hello world.", "This is...", "a test!", "New line?", "yes"]
    assert r.w == ["hello", "world", "this", "is", "a", "test", "new", "line", "yes"]
    assert r.k[:4] == ["Hello", "world", ".", "This"]


def test_ngrams_guard_short_arrays(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "w array<string>")
    got = [r.g for r in df.select(segment.ngrams("w", 2).alias("g")).collect()]
    assert got == [["a b", "b c"], [], []]


def test_no_python_udf_in_text_plans(spark, edge_df):
    plan = edge_df.select(text.preprocess_text("t"), text.postprocess("t"),
                          F.size(segment.sentences("t")))._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_first_sentence_is_the_first_of_all(spark):
    from corpuslens.functions import segment
    raw = ["", None, "One. Two.", "  \n\n  x! y", "...abc. d", " . a", "   ", "\n", "a", "?! \n b?? c", "x\ny", " \t. z"]
    df = spark.createDataFrame([(t,) for t in raw], "t string")
    for r in df.select("t", segment.first_sentence("t").alias("a"), segment.sentences("t").alias("s")).collect():
        assert r.a == (r.s[0] if r.s else None), r
