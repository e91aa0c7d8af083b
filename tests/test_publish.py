import os

import pytest
from pyspark.sql import functions as F

from corpuslens.sources import publish as P


def _tables(spark, tag):
    return {n: spark.range(3).withColumn("v", F.lit(f"{n}-{tag}")) for n in ("x", "y")}


def _tags(found):
    return {n: {r.v for r in df.collect()} for n, df in found.items()}


def test_fingerprint_is_of_the_content(spark):
    rows = [(1, "a", None), (2, None, 3.0), (2, None, 3.0)]
    df = spark.createDataFrame(rows, "i long, s string, d double")
    same = spark.createDataFrame(rows[::-1], df.schema).repartition(3)
    assert P.fingerprint(df, {"k": 1}) == P.fingerprint(same, {"k": 1})
    others = [P.fingerprint(df, {"k": 2}), P.fingerprint(df.limit(0)), P.fingerprint(df.distinct(), {"k": 1}),
              P.fingerprint(df.withColumnRenamed("s", "t"), {"k": 1}),
              P.fingerprint(df.withColumn("s", F.coalesce("s", F.lit(""))), {"k": 1})]
    assert len({P.fingerprint(df, {"k": 1}), *others}) == 6


def test_cache_is_used_for_the_same_input_only(spark, tmp_path):
    root, calls = f"{tmp_path}/c", []
    one, two = spark.range(5), spark.range(6)

    def build(tag):
        def run():
            calls.append(tag)
            return _tables(spark, tag)
        return run

    for source, tag in ((one, 1), (one, 2), (two, 3), (two, 4), (one, 5)):
        got = _tags(P.load_or_build(spark, root, ["x", "y"], build(tag), source, {"o": 1}))
        assert got["x"] == {"x-1" if source is one else "x-3"}
    assert calls == [1, 3]
    P.load_or_build(spark, root, ["x", "y"], build(6), one, {"o": 2})
    assert calls == [1, 3, 6]


def test_a_writer_that_dies_leaves_the_old_version(spark, tmp_path):
    root = f"{tmp_path}/c"
    P.publish(spark, root, _tables(spark, "old"), "k1")
    reader = P.read_published(spark, root)
    broken = _tables(spark, "new")
    broken["y"] = broken["y"].withColumn("v", F.raise_error(F.lit("dies here")).cast("string"))
    with pytest.raises(Exception, match="dies here"):
        P.publish(spark, root, broken, "k2")
    assert _tags(P.read_published(spark, root)) == {"x": {"x-old"}, "y": {"y-old"}}
    P.publish(spark, root, _tables(spark, "new"), "k2")
    assert _tags(P.read_published(spark, root)) == {"x": {"x-new"}, "y": {"y-new"}}
    # whoever started on the old version goes on with it
    assert _tags(reader) == {"x": {"x-old"}, "y": {"y-old"}}


def test_two_writers_take_different_numbers(spark, tmp_path, monkeypatch):
    root = f"{tmp_path}/c"
    P.publish(spark, root, _tables(spark, 1), "k1")
    seen = iter([[], [1]])
    real = P._numbers
    monkeypatch.setattr(P, "_numbers", lambda s, r: next(seen))
    P.publish(spark, root, _tables(spark, 2), "k2")  # believes that there is none yet, then sees the first
    monkeypatch.setattr(P, "_numbers", real)
    assert real(spark, root) == [1, 2]
    assert P.manifest(spark, root, 1)["fingerprint"] == "k1" and P.manifest(spark, root)["fingerprint"] == "k2"
    assert not [f for f in os.listdir(root) if f.startswith("_")]


def test_nothing_published(spark, tmp_path):
    assert P.manifest(spark, f"{tmp_path}/none") is None
    with pytest.raises(FileNotFoundError):
        P.read_published(spark, f"{tmp_path}/none")
