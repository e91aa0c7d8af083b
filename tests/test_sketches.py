import pytest
from pyspark.sql import functions as F

from corpuslens.operators import sketches as S
from corpuslens.operators import stats


@pytest.fixture(scope="module")
def values(spark):
    """A heavy-tailed group with many slices, a small one, and nulls."""
    v = F.pow(F.pmod(F.xxhash64("id"), F.lit(1_000_003)).cast("double"), F.lit(1.5))
    big = spark.range(200_000).select(F.lit("big").alias("g"), (F.col("id") % 37).alias("slice"), v.alias("v"))
    small = spark.range(9).select(F.lit("small"), F.col("id") % 2, F.col("id").cast("double"))
    none = spark.range(3).select(F.lit("none"), F.lit(0).cast("long"), F.lit(None).cast("double"))
    return big.unionByName(small.toDF("g", "slice", "v")).unionByName(none.toDF("g", "slice", "v"))


def test_merged_sketches_keep_the_stated_rank_error(spark, values, tmp_path):
    S.write_slices(S.slice_sketches(values, ["g"], "slice", "v"), f"{tmp_path}/s")
    kept = spark.read.parquet(f"{tmp_path}/s")
    assert kept.count() == 37 + 2
    whole = S.merged(kept, ["g"])
    box = S.box(whole, ["g"])
    got = {r.g: r for r in S.exact_ranks(values, box, ["g"], "v", S.NAMES).collect()}
    assert set(got) == {"big", "small"} and got["big"].n == 200_000
    for p, name in zip(stats.QUARTILES, S.NAMES):
        for r in got.values():
            assert r[f"{name}_below"] <= (p + S.RANK_ERROR) * r.n and r[f"{name}_upto"] >= (p - S.RANK_ERROR) * r.n
    exact = {r.g: r for r in stats.box_stats(values, ["g"], "v").collect()}
    near = {r.g: r for r in box.collect()}
    assert near["small"].n == 9 and near["small"].median == 4 and near["small"].whisker_high == 8
    assert near["big"].whisker_low == exact["big"].whisker_low  # the exact minimum
    assert near["big"].whisker_high == pytest.approx(exact["big"].whisker_high, rel=0.05)


def test_a_slice_is_replaced_and_others_stay(spark, values, tmp_path):
    path = f"{tmp_path}/s"
    S.write_slices(S.slice_sketches(values, ["g"], "slice", "v"), path)
    again = values.where("slice = 1 and g = 'small'").withColumn("v", F.col("v") + 100)
    S.write_slices(S.slice_sketches(again, ["g"], "slice", "v"), path)
    whole = {r.g: r for r in S.merged(spark.read.parquet(path), ["g"]).collect()}
    assert whole["small"].high == 107 and whole["small"].n == 9
    assert whole["big"].n == 200_000 - values.where("slice = 1 and g = 'big'").count()


def test_no_rows(spark, values):
    assert S.box(S.merged(S.slice_sketches(values.limit(0), ["g"], "slice", "v"), ["g"]), ["g"]).collect() == []


def test_the_sketch_side_stays_in_the_jvm(values):
    plan = S.merged(S.slice_sketches(values, ["g"], "slice", "v"), ["g"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "partial_kll" in plan


def test_histograms_of_two_columns_are_those_of_each(spark):
    df = spark.createDataFrame([("a", float(i), float(i * i) if i % 4 else None, 5.0) for i in range(30)],
                               "g string, x double, y double, z double")
    got = sorted(stats.histograms(df, ["g"], {"X": "x", "Y": "y", "Z": "z"}, 7).select(
        "g", "score", "bucket", "bin_low", "bin_high", "count").collect())
    want = []
    for name, col in (("X", "x"), ("Y", "y"), ("Z", "z")):
        want += stats.histogram(df, ["g"], col, 7).select("g", F.lit(name), "bucket", "bin_low", "bin_high", "count").collect()
    assert got == sorted(want)
