"""Slice schedules, dense row numbering and epoch assignment."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from corpuslens.operators import slices
from corpuslens.operators.intervals import interval_join
from corpuslens.operators.ordering import group_row_index, row_index


@pytest.mark.parametrize("split,expected", [
    (0.15, [(0, 15), (15, 30), (30, 45), (44, 59), (60, 75), (75, 90), (89, 100)]),
    (0.3, [(0, 30), (30, 60), (60, 90), (89, 100)]),
    (0.25, [(0, 25), (25, 50), (50, 75), (75, 100)]),
    (0.5, [(0, 50), (50, 100)]),
    (1.5, [(0, 100)]),
])
def test_compat_schedule(split, expected):
    assert [(b, e) for _, b, e in slices.epoch_schedule(split)] == expected


def test_exact_schedule_partitions_rows():
    sched = slices.epoch_schedule(0.15, mode="exact")
    assert sched[0][1] == 0 and sched[-1][2] == 100
    assert all(sched[i][2] == sched[i + 1][1] for i in range(len(sched) - 1))


def test_row_index_is_dense_and_ordered(spark):
    df = spark.range(0, 5000, 7, numPartitions=6).withColumnRenamed("id", "k")
    got = row_index(df, ["k"]).collect()
    idx = sorted((r.k, r.idx) for r in got)
    assert [i for _, i in idx] == list(range(len(idx)))


def test_group_row_index_matches_window(spark):
    df = spark.range(0, 3000, numPartitions=5).select(
        F.col("id").alias("k"), (F.col("id") % 3).cast("string").alias("g"))
    ours = {(r.g, r.k): r.idx for r in group_row_index(df, ["g"], ["k"]).collect()}
    w = Window.partitionBy("g").orderBy("k")
    ref = {(r.g, r.k): r.i for r in df.select("g", "k", (F.row_number().over(w) - 1).alias("i")).collect()}
    assert ours == ref


def test_assign_epochs_overlap_and_gap(spark):
    df = spark.range(0, 100).select(F.col("id").alias("doc_id"), F.lit("train").alias("split"))
    ix = slices.indexed_splits(df, "split", "doc_id")
    out = slices.assign_epochs(ix, slices.schedule_frame(slices.split_counts(ix), slices.schedule_table(spark, 0.15)))
    per_row = {r.idx: r.n for r in out.groupBy("idx").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert per_row[44] == 2          # in slices 3 and 4 (overlap)
    assert 59 not in per_row         # between 4 and 5 (gap)
    assert per_row[0] == 1 and per_row[99] == 1


def test_percent_slice_bounds(spark):
    df = spark.range(0, 10).select(F.col("id").alias("doc_id"), F.lit("train").alias("split"))
    ix = slices.indexed_splits(df, "split", "doc_id")
    got = sorted(r.idx for r in slices.percent_slice(ix, ["train"], 25, 45).collect())
    assert got == [2, 3]             # round-half-even: 2.5 -> 2, 4.5 -> 4


@pytest.mark.parametrize("mode", ["compat", "exact"])
def test_schedule_table_is_the_schedule(spark, mode):
    rows = slices.schedule_table(spark, 0.15, 3, mode).orderBy("epoch").collect()
    assert [tuple(r) for r in rows] == slices.epoch_schedule(0.15, 3, mode)


def _joined(points, spans):
    return sorted((p, b, e) for p in points for b, e in spans if None not in (p, b, e) and b <= p < e)


def test_interval_join_equals_a_nested_loop(spark):
    rng = random.Random(5)
    points = [rng.randint(-500, 500) for _ in range(300)] + [None, 0, 0, -(1 << 40)]
    spans = [(b, b + rng.choice([-3, 0, 1, 2, 3, 64, 65, 500])) for b in (rng.randint(-520, 520) for _ in range(200))]
    spans += [(-1000, 1000), (-(1 << 41), 1 << 41), (0, 1), (0, 1), (None, 5), (5, None)]
    p = spark.createDataFrame([(x,) for x in points], "x long")
    s = spark.createDataFrame(spans, "b long, e long")
    got = sorted(tuple(r) for r in interval_join(p, s, "x", "b", "e").select("x", "b", "e").collect())
    assert got == _joined(points, spans)
    assert interval_join(p, s.limit(0), "x", "b", "e").collect() == []
    assert interval_join(p.limit(0), s, "x", "b", "e").collect() == []


def test_a_schedule_of_100000_slices_is_an_equality_join(spark):
    rows = spark.range(0, 250_000).select(F.col("id").alias("idx"), F.lit("train").alias("split"))
    counts = spark.createDataFrame([("train", 250_000)], "split string, n_rows long")
    out = slices.assign_epochs(rows, slices.row_schedule(counts, 100_000))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    got = out.agg(F.count(F.lit(1)), F.countDistinct("epoch"), F.max("epoch")).first()
    assert tuple(got) == (250_000, 100_000, 100_000)
    per = out.groupBy("epoch").count().agg(F.min("count"), F.max("count")).first()
    assert tuple(per) == (2, 3)
