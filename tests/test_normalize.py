"""Min-max rules, row means, category scores and pairwise comparison."""

import pytest

from corpuslens.operators import compare, normalize


def _norm(spark, values, rule, lower=(), flip=False):
    df = spark.createDataFrame([(f"m{i}", v) for i, v in enumerate(values)], "model string, X double")
    out = normalize.minmax_normalize(df, ["X"], ["X"] if lower else [], rule, flip_after=flip)
    return [r.X for r in out.orderBy("model").collect()]


def test_constant_column_rules(spark):
    assert _norm(spark, [2.0, 2.0, 2.0], "null") == [None, None, None]
    assert _norm(spark, [2.0, 2.0, 2.0], "zero") == [0.0, 0.0, 0.0]
    assert _norm(spark, [2.0, 2.0, 2.0], "zero", lower=True, flip=True) == [1.0, 1.0, 1.0]
    assert _norm(spark, [2.0, 2.0, 2.0], "half") == [0.5, 0.5, 0.5]


def test_direction(spark):
    assert _norm(spark, [1.0, 3.0, 5.0], "null") == [0.0, 0.5, 1.0]
    assert _norm(spark, [1.0, 3.0, 5.0], "null", lower=True) == [1.0, 0.5, 0.0]
    assert _norm(spark, [1.0, 3.0, 5.0], "zero", lower=True, flip=True) == [1.0, 0.5, 0.0]


def test_nan_is_skipped(spark):
    got = _norm(spark, [1.0, float("nan"), 5.0], "null")
    assert got == [0.0, None, 1.0]


def test_row_mean(spark):
    df = spark.createDataFrame([(0.2, None, 0.4), (None, None, None)], "a double, b double, c double")
    got = [r.m for r in df.select(normalize.row_mean(["a", "b", "c"]).alias("m")).collect()]
    assert got[0] == pytest.approx(0.3) and got[1] is None


def test_bad_rule(spark):
    df = spark.createDataFrame([("a", 1.0)], "model string, X double")
    with pytest.raises(ValueError):
        normalize.minmax_normalize(df, ["X"], on_constant="bogus")


def test_pairwise_fixture(spark):
    a = spark.createDataFrame([("FKGL", 9.0), ("ROUGE", 0.4), ("BLEU", 8.0), ("X", 1.0)], "metric string, a double")
    b = spark.createDataFrame([("FKGL", 10.0), ("ROUGE", 0.3), ("BLEU", 8.0)], "metric string, b double")
    r = compare.pairwise_wins(a, b, ["FKGL", "DCRS", "CLI"], "A", "B").first()
    assert (r.n_common, r.wins_a, r.wins_b, r.verdict) == (3, 2, 0, "A")
    long = compare.pairwise_long(a, b, "A", "B")
    assert long.count() == 6
    diff = {r.metric: r.diff for r in compare.diff_table(a, b, ["ROUGE", "FKGL", "METEOR"]).collect()}
    assert diff["ROUGE"] == pytest.approx(-0.1) and diff["FKGL"] == 1.0 and diff["METEOR"] is None


def test_tie_verdict(spark):
    a = spark.createDataFrame([("BLEU", 8.0)], "metric string, a double")
    b = spark.createDataFrame([("BLEU", 8.0)], "metric string, b double")
    assert compare.pairwise_wins(a, b, [], "A", "B").first().verdict == "Tie"


def test_ranges_per_group(spark):
    df = spark.createDataFrame([("a", "train", 1.0), ("b", "train", 3.0), ("c", "valid", 10.0), ("d", "valid", 20.0)],
                               "model string, split string, X double")
    out = normalize.minmax_normalize(df, ["X"], [], "null", partition_by=["split"])
    got = {r.model: r.X for r in out.collect()}
    assert got == {"a": 0.0, "b": 1.0, "c": 0.0, "d": 1.0}
