"""Skew helpers, batched generation and resumption."""

import tempfile

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from corpuslens.operators import generate, skew


@pytest.fixture(scope="module")
def hot(spark):
    # one key holds most rows
    return spark.range(0, 4000).select(
        F.col("id").alias("vid"), F.when(F.col("id") % 10 < 8, F.lit(0)).otherwise(F.col("id") % 5).alias("g"),
        ((F.col("id") * 7919) % 1000).cast("double").alias("v"))


def test_salted_join_equals_plain_join(spark, hot):
    small = spark.createDataFrame([(i, f"label{i}") for i in range(5)], "g long, name string")
    a = skew.salted_join(hot, small, ["g"], F.col("vid"), 5).select("vid", "name").collect()
    b = hot.join(small, "g").select("vid", "name").collect()
    assert sorted(a) == sorted(b)


def test_salts_follow_the_most_frequent_key(spark, hot):
    assert skew.salts_for(hot, ["g"], 1000) == 4
    assert skew.salts_for(hot, ["g"]) == 1
    assert skew.salts_for(hot.where("false"), ["g"]) == 1


def test_top_k_per_group_equals_window(spark, hot):
    order = [F.col("v").desc(), F.col("vid").asc()]
    ours = {(r.g, r.rank): r.vid for r in skew.top_k_per_group(hot, ["g"], order, 5, F.col("vid"), 4).collect()}
    w = Window.partitionBy("g").orderBy(*order)
    ref = {(r.g, r.rank): r.vid for r in hot.withColumn("rank", F.row_number().over(w))
           .where("rank <= 5").collect()}
    assert ours == ref


def test_generate_batches_and_strips(spark):
    def fn(texts):
        # runs in the Python worker: report the batch size through the output
        return [f"  {t.upper()}|{len(texts)}\n" for t in texts]

    df = spark.createDataFrame([(i, f"t{i}") for i in range(20)], "doc_id long, prompt string").coalesce(1)
    out = {r.doc_id: r.summary for r in generate.generate(df, fn, batch_size=8).collect()}
    assert len(out) == 20 and out[3].startswith("T3|")
    assert max(int(v.split("|")[1]) for v in out.values()) <= 8


def test_generate_rejects_wrong_length(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, prompt string")
    with pytest.raises(Exception):
        generate.generate(df, lambda t: [], batch_size=8).collect()


def test_resume_skips_done_rows(spark):
    path = tempfile.mkdtemp(prefix="gen-") + "/ckpt"
    df = spark.createDataFrame([(i, f"a\nt{i}") for i in range(10)], "doc_id long, prompt string")
    fn = generate.body_model()
    generate.generate_resumable(spark, df.where("doc_id < 4"), fn, path, tag={"attempt": 1})
    rows = generate.generate_resumable(spark, df, fn, path, tag={"attempt": 2}).collect()
    assert len(rows) == 10 and len({r.doc_id for r in rows}) == 10
    assert {r.doc_id for r in rows if r.attempt == 1} == {0, 1, 2, 3}
    assert all(r.summary == f"t{r.doc_id}" for r in rows)
    assert generate.generate_resumable(spark, df, fn, path, tag={"attempt": 3}).where("attempt = 3").count() == 0


def test_a_failure_keeps_finished_slices(spark):
    path = tempfile.mkdtemp(prefix="gen-") + "/ckpt"
    df = spark.createDataFrame([(i, f"t{i}") for i in range(40)], "doc_id long, prompt string")
    slice_of = {r.doc_id: r.s for r in df.select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(4)).alias("s")).collect()}
    bad = {f"t{i}" for i, s in slice_of.items() if s == 2}

    def failing(texts):
        if bad & set(texts):
            raise RuntimeError("model gone")
        return [f"first {t}" for t in texts]

    with pytest.raises(Exception):
        generate.generate_resumable(spark, df, failing, path, slices=4)
    kept = generate.read_checkpoint(spark, path).collect()  # the slice that failed left nothing behind
    assert {r.doc_id for r in kept} == {i for i, s in slice_of.items() if s < 2} and kept
    rows = generate.generate_resumable(spark, df, lambda ts: [f"second {t}" for t in ts], path, slices=4).collect()
    assert len(rows) == 40
    assert all(r.summary == ("first" if slice_of[r.doc_id] < 2 else "second") + f" t{r.doc_id}" for r in rows)


def test_checkpoint_of_a_broken_table_is_not_taken_for_none(spark):
    path = tempfile.mkdtemp(prefix="gen-") + "/ckpt"
    assert generate.read_checkpoint(spark, path) is None
    spark.range(1).selectExpr("cast(id as string) as value").write.text(path)
    with pytest.raises(Exception):
        generate.read_checkpoint(spark, path)


def test_body_model_matches_definition():
    assert generate.body_model()(["Abstract line\nOne. Two! Three?", "no newline", None]) == ["One. Two! Three?", "", ""]
    assert generate.body_model(" \n")(["a\nb"]) == [" \nb \n"]
