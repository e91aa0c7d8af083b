import glob
import os

from pyspark.sql import functions as F

from corpuslens.sources import layout
from corpuslens.sources.tables import corpus, read_table

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _spoil(tmp_path, kept):
    """Files of other folders can't be read any more, and needn't be."""
    for f in glob.glob(f"{tmp_path}/corpus/*/*/*.parquet"):
        if kept not in f:
            with open(f, "wb") as out:
                out.write(b"not a table")


def test_a_split_read_opens_that_split_only(spark, tmp_path):
    path = layout.layout_of(spark, SF, f"{tmp_path}/corpus")
    everything = layout.read_layout(spark, path)
    one = layout.read_layout(spark, path, "en", "validation")
    _spoil(tmp_path, "dataset=en/split=validation")
    files = {r[0] for r in one.select(F.input_file_name()).collect()}
    assert files and all("dataset=en/split=validation" in f for f in files)
    assert len(files) < len(everything.inputFiles()) / 4
    assert "PartitionFilters: [isnotnull(dataset" in _plan(one) and "PushedFilters: []" in _plan(one)
    cols = ["doc_id", "dataset", "split", "title", "article", "summary"]
    want = corpus(spark, SF, "en", "validation").select(cols).collect()
    assert sorted(one.select(cols).collect()) == sorted(want)


def test_a_column_read_leaves_the_texts(spark, tmp_path):
    path = layout.layout_of(spark, SF, f"{tmp_path}/corpus")
    plan = _plan(layout.read_layout(spark, path, split="test").select("doc_id", "dataset"))
    assert "ReadSchema: struct<doc_id:bigint>" in plan


def test_requested_splits_are_pruned_at_run_time(spark, tmp_path):
    path = layout.layout_of(spark, SF, f"{tmp_path}/corpus")
    spark.createDataFrame([("en", "test", 1), ("de", "test", 0), ("xx", "test", 1)], "dataset string, split string, w int") \
        .write.parquet(f"{tmp_path}/wanted")
    wanted = spark.read.parquet(f"{tmp_path}/wanted").where("w = 1")
    got = layout.read_requested(spark, path, wanted)
    assert "dynamicpruning" in _plan(got)
    _spoil(tmp_path, "dataset=en/split=test")
    want = corpus(spark, SF, "en", "test").select("doc_id", "article").collect()
    assert sorted(got.select("doc_id", "article").collect()) == sorted(want) and want


def test_null_datasets_and_few_files(spark, tmp_path):
    docs = read_table(spark, SF, "documents").withColumn("lang", F.when(F.col("doc_id") % 5 > 0, F.col("lang")))
    path = layout.write_layout(docs, f"{tmp_path}/corpus", files_per_folder=2)
    got = layout.read_layout(spark, path)
    assert got.count() == docs.count()
    assert got.where("dataset is null").count() == docs.where("lang is null").count() > 0
    folders = {}
    for f in got.inputFiles():
        folders.setdefault(f.rsplit("/", 1)[0], []).append(f)
    assert max(map(len, folders.values())) <= 2
