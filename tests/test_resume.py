"""Slices sized by bytes, resumption by key, and the stream with keyed state."""

import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslens.operators import generate
from corpuslens.session import remove_folder, scratch_dir
from corpuslens.streaming.generate_stream import start_keyed_generate_stream

SCHEMA = "doc_id long, prompt string"


def _folder(name):
    return tempfile.mkdtemp(prefix="resume-") + "/" + name


def _echo(word):
    return lambda texts: [f"{word} {t}" for t in texts]


def test_slices_follow_the_bytes(spark):
    df = spark.createDataFrame([(i, "x" * 99) for i in range(100)] + [(100, None), (101, "")], SCHEMA)
    assert generate.slice_count(df, slice_bytes=1000) == 11
    assert generate.slice_count(df, slice_bytes=1 << 20) == 1
    assert generate.slice_count(df.where("false")) == 0


def test_a_slice_reads_its_own_files_only(spark):
    df = spark.createDataFrame([(i, f"t{i}") for i in range(200)], SCHEMA)
    path = generate.stage_slices(df, _folder("staged"), 5)
    rows = spark.read.parquet(path)
    assert rows.count() == 200
    one = rows.where(F.col(generate.SLICE) == 3)
    files = {r[0] for r in one.select(F.input_file_name()).distinct().collect()}
    assert files and all(f"{generate.SLICE}=3/" in f for f in files)
    assert "PartitionFilters: [isnotnull(_slice" in one._jdf.queryExecution().toString()


def test_a_hot_key_is_staged_in_several_files(spark, monkeypatch):
    monkeypatch.setattr(generate, "FILE_BYTES", 100)
    df = spark.createDataFrame([(1, f"t{i}") for i in range(400)], SCHEMA)
    # tiny files would be merged again
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = generate.stage_slices(df, _folder("staged"), 2, slice_bytes=800)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = spark.read.parquet(path).select(F.input_file_name()).distinct().count()
    assert files > 1


def test_resume_by_bytes_does_only_what_is_missing(spark):
    path = _folder("out")
    df = spark.createDataFrame([(i, f"t{i:03d}") for i in range(60)] + [(None, "nokey"), (7, "t007")], SCHEMA)
    first = generate.generate_resumable(spark, df.where("doc_id < 20"), _echo("a"), path, slice_bytes=50)
    assert first.count() == 21 and len(generate.committed_slices(spark, path)) == 3
    rows = generate.generate_resumable(spark, df, _echo("b"), path, slice_bytes=50).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.summary) for r in rows) == sorted(
        [(False, i, f"{'a' if i < 20 else 'b'} t{i:03d}") for i in [*range(60), 7]] + [(True, 0, "b nokey")])
    before = generate.committed_slices(spark, path)
    again = generate.generate_resumable(spark, df, _echo("c"), path, slice_bytes=50)
    assert again.count() == 62 and generate.committed_slices(spark, path) == before


def test_nothing_to_generate_gives_an_empty_table(spark):
    out = generate.generate_resumable(spark, spark.createDataFrame([], SCHEMA), _echo("a"), _folder("out"),
                                      tag={"attempt": 1})
    assert out.count() == 0 and out.columns == ["doc_id", "summary", "attempt"]


def test_only_scratch_folders_are_removed(spark):
    with pytest.raises(ValueError):
        remove_folder(spark, _folder("mine"))
    path = scratch_dir(spark, "gone")
    spark.range(1).write.parquet(path)
    remove_folder(spark, path)
    with pytest.raises(Exception):
        spark.read.parquet(path)


STREAM = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


class _Deliveries:
    def __init__(self, spark):
        self.spark, self.base = spark, _folder("stream")

    def deliver(self, name, rows):
        self.spark.createDataFrame(rows, STREAM).coalesce(1).write.parquet(f"{self.base}/source/{name}")

    def run(self, fn, **options):
        start_keyed_generate_stream(self.spark, self.base + "/source", STREAM, self.base + "/sink",
                                    self.base + "/checkpoint", fn, **options).awaitTermination()
        rows = self.spark.read.parquet(self.base + "/sink").collect()
        return sorted((r.doc_id is None, r.doc_id or 0, r.summary) for r in rows)


def test_a_key_delivered_again_is_generated_once(spark):
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting)
    s = _Deliveries(spark)
    s.deliver("a", [(1, "x"), (2, "y"), (2, "y"), (None, "n"), (None, "n"), (None, "m")])
    s.deliver("b", [(1, "x"), (3, "z")])
    got = s.run(_echo("first"), files_per_trigger=1)
    assert got == [(False, 1, "first x"), (False, 2, "first y"), (False, 3, "first z"),
                   (True, 0, "first m"), (True, 0, "first n")]
    # a restart that finds old keys in new files, one of them with another text
    s.deliver("c", [(2, "changed"), (3, "z"), (4, "w"), (5, None)])
    assert s.run(_echo("second")) == sorted([*got, (False, 4, "second w"), (False, 5, "second None")])
    assert spark.conf.get(setting) == before


def test_a_changed_text_is_generated_again_if_asked(spark):
    s = _Deliveries(spark)
    s.deliver("a", [(1, "x"), (2, "y")])
    s.run(_echo("first"), again_if_changed=True)
    s.deliver("b", [(1, "x"), (2, "changed")])
    assert s.run(_echo("second"), again_if_changed=True) == [
        (False, 1, "first x"), (False, 2, "first y"), (False, 2, "second changed")]


def test_a_restart_after_a_failing_model_repeats_and_skips_nothing(spark):
    s = _Deliveries(spark)
    s.deliver("a", [(1, "x")])
    s.run(_echo("first"))
    s.deliver("b", [(1, "x"), (2, "bad")])

    def failing(texts):
        raise RuntimeError("model gone")

    with pytest.raises(Exception):
        s.run(failing)
    assert s.run(_echo("second")) == [(False, 1, "first x"), (False, 2, "second bad")]
