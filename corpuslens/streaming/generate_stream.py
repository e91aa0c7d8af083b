"""Structured Streaming form of batch generation.

Article files arriving in a folder are turned into prompts, passed through
the model function in Arrow batches (a stateless column function) and appended
to a Parquet sink.  A micro-batch takes a bounded number of files, and the
checkpoint location records each one's commit, so a restarted job continues
behind the last finished micro-batch -- the streaming equivalent of resuming
from a checkpoint table.

``start_keyed_generate_stream`` is exactly-once by key as well: the keys that
went through are kept in the state store, so an article that comes again, in
another file or after a restart, is dropped before it reaches the model.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslens.operators.generate import DEFAULT_BATCH_SIZE, generate


# Input files of one micro-batch, which is what a failure can lose.
FILES_PER_TRIGGER = 16


def start_generate_stream(spark: SparkSession, source_dir: str, schema: T.StructType, sink_dir: str,
                          checkpoint_dir: str, fn: Callable[[list[str]], list[str]], key: str = "doc_id",
                          text_col: str = "text", file_glob: str = "*.parquet",
                          batch_size: int = DEFAULT_BATCH_SIZE, available_now: bool = True,
                          files_per_trigger: int = FILES_PER_TRIGGER):
    src = (spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
           .option("maxFilesPerTrigger", files_per_trigger).parquet(source_dir))
    prompts = src.select(key, F.col(text_col).alias("prompt"))
    out = generate(prompts, fn, "prompt", batch_size=batch_size).drop("prompt")
    writer = out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(sink_dir)


_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def once_per_key(rows: DataFrame, key: str = "doc_id", text_col: str = "text", again_if_changed: bool = False) -> DataFrame:
    """The first row of every key of a stream; with ``again_if_changed`` the
    first of every (key, text).  Rows without a key are told apart by their
    text.  Only the key and a hash stay in the state, never a text."""
    mark = F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    if not again_if_changed:
        mark = F.when(F.col(key).isNull(), mark)
    return rows.withColumn("_mark", mark).dropDuplicates([key, "_mark"]).drop("_mark")


def start_keyed_generate_stream(spark: SparkSession, source_dir: str, schema: T.StructType, sink_dir: str,
                                checkpoint_dir: str, fn: Callable[[list[str]], list[str]], key: str = "doc_id",
                                text_col: str = "text", carry: Sequence[str] = (), file_glob: str = "*.parquet",
                                batch_size: int = DEFAULT_BATCH_SIZE, available_now: bool = True,
                                files_per_trigger: int = FILES_PER_TRIGGER, again_if_changed: bool = False):
    """Generate once for every key that ever arrives; ``carry`` names columns
    that go along.  Of rows of one key in one micro-batch any one may be the
    first.  The state grows by some bytes a key, on the executors' disks and
    in ``checkpoint_dir``, which every executor must reach; its number of
    partitions is the shuffle width of the first start.  Files are found at
    any depth below ``source_dir``."""
    src = (spark.readStream.schema(schema).option("pathGlobFilter", file_glob).option("recursiveFileLookup", True)
           .option("maxFilesPerTrigger", files_per_trigger).parquet(source_dir))
    fresh = once_per_key(src.select(key, *carry, F.col(text_col).alias("prompt")), key, "prompt", again_if_changed)
    out = generate(fresh, fn, "prompt", batch_size=batch_size).drop("prompt")
    writer = out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    before = spark.conf.get(_STATE_STORE)
    # a stream takes the settings of the moment it starts
    spark.conf.set(_STATE_STORE, _ROCKSDB)
    try:
        return writer.start(sink_dir)
    finally:
        spark.conf.set(_STATE_STORE, before)
