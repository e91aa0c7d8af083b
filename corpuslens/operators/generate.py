"""Batched, resumable generation over a table with a pluggable model function.

``generate`` adds the outputs as a column: the model function gets lists of
``batch_size`` inputs inside a scalar-iterator pandas UDF, so a task may build
its model once, and no row has to be joined back.

``generate_resumable`` works through the table in slices by key hash, as many
as the input's bytes ask for.  What is missing is laid out by slice once, so a
slice reads its own files and nothing else.  It is committed as soon as it is
done (Spark's atomic job commit into its own folder), so a failure loses the
slice it happens in, and a rerun does only what is missing.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslens.functions import text
from corpuslens.session import child_names, path_exists, remove_folder, scratch_dir, ship_package

# Default batch size of generation and the same sentence
# pattern as functions.segment, for the Python default model.
DEFAULT_BATCH_SIZE = 8
_SENTENCE_RE = re.compile(r"[^.!?\n]+[.!?]*")
SLICE = "_slice"
#: input of one slice, which is what a failure can lose
SLICE_BYTES = 8 << 30
#: input of one file of a slice, which is one task's work at most
FILE_BYTES = 64 << 20


def body_model(pad: str = "") -> Callable[[list[str]], list[str]]:
    """Default model: all sentences of the article's body (what follows its
    first line), one space between them; ``pad`` is put on both ends."""
    def fn(texts: list[str]) -> list[str]:
        out = []
        for t in texts:
            body = t.split("\n", 1)[1].strip() if t and "\n" in t else ""
            sentences = (s.strip(" ") for s in _SENTENCE_RE.findall(body))
            out.append(pad + " ".join(s for s in sentences if s) + pad)
        return out
    return fn


def generate(df: DataFrame, fn: Callable[[list[str]], list[str]], input_col: str = "prompt",
             output_col: str = "summary", batch_size: int = DEFAULT_BATCH_SIZE, strip: bool = True) -> DataFrame:
    """``df`` plus ``output_col``, stripped of edge whitespace unless told not to."""
    ship_package(df.sparkSession)

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for inputs in batches:
            outs = []
            for start in range(0, len(inputs), batch_size):
                part = inputs.iloc[start:start + batch_size].tolist()
                got = list(fn(part))
                if len(got) != len(part):
                    raise ValueError("model function must return one output per input")
                outs += got
            yield pd.Series(outs, dtype=object)

    # never evaluated twice, however often the column is used
    out = df.withColumn(output_col, run.asNondeterministic()(F.col(input_col)))
    return out.withColumn(output_col, text.strip(output_col)) if strip else out


def committed_slices(spark: SparkSession, path: str) -> list[str]:
    """Folders of the slices that have been committed; a failed write may
    leave a folder without its mark.  Anything else in the folder is not ours
    and raises."""
    if not path_exists(spark, path):
        return []
    names = child_names(spark, path)
    strange = [n for n in names if not n.startswith((f"{SLICE}=", "_", "."))]
    if strange:
        raise ValueError(f"{path!r} is no checkpoint table: it holds {strange[0]!r}")
    folders = [f"{path.rstrip('/')}/{n}" for n in sorted(names) if n.startswith(f"{SLICE}=")]
    return [f for f in folders if path_exists(spark, f + "/_SUCCESS")]


def read_checkpoint(spark: SparkSession, path: str) -> DataFrame | None:
    """What earlier runs committed; None if there is nothing yet."""
    done = committed_slices(spark, path)
    return spark.read.parquet(*done) if done else None


def missing_rows(df: DataFrame, done: DataFrame | None, key: str = "doc_id") -> DataFrame:
    """The rows of ``df`` whose key isn't in ``done``; a null key is a key."""
    if done is None:
        return df
    keys = done.select(F.col(key).alias("_done"))
    return df.join(keys, F.col(key).eqNullSafe(F.col("_done")), "left_anti")


def slice_count(df: DataFrame, input_col: str = "prompt", slice_bytes: int = SLICE_BYTES) -> int:
    """How many slices of about ``slice_bytes`` the inputs make; 0 for none."""
    size = F.octet_length(F.coalesce(F.col(input_col).cast("string"), F.lit(""))) + 1
    return -(-(df.agg(F.sum(size)).first()[0] or 0) // slice_bytes)


def stage_slices(df: DataFrame, path: str, slices: int, key: str = "doc_id", slice_bytes: int = SLICE_BYTES) -> str:
    """Lay ``df`` out in a folder per slice, each in files of at most about
    ``FILE_BYTES``, so that a slice is read without the others.  Rows of a key
    share a slice, however many they are; its files are dealt by all columns."""
    files = -(-slice_bytes // FILE_BYTES)
    staged = df.withColumn(SLICE, F.pmod(F.xxhash64(key), F.lit(slices)).cast("int"))
    share = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns], F.lit(1)), F.lit(files))
    staged.repartition(SLICE, share).write.partitionBy(SLICE).parquet(path)
    return path


def generate_resumable(spark: SparkSession, df: DataFrame, fn, checkpoint_path: str,
                       key: str = "doc_id", input_col: str = "prompt", output_col: str = "summary",
                       batch_size: int = DEFAULT_BATCH_SIZE, tag: dict | None = None,
                       slices: int | None = None, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """(key, output, tags) of all rows: what is missing in the checkpoint table
    is generated, slice by slice; ``slices`` fixes their number.

    Each call works in folders of its own and changes nothing that an earlier
    one committed.  Rows without a key count as one key.  The staged inputs
    stay in the session's checkpoint folder until the last slice is done.
    """
    todo = missing_rows(df.select(key, input_col), read_checkpoint(spark, checkpoint_path), key)
    n = slice_count(todo, input_col, slice_bytes)
    if n == 0:
        found = read_checkpoint(spark, checkpoint_path)
        if found is not None:
            return found
    n = max(slices or n, 1)
    staged = stage_slices(todo, scratch_dir(spark, "slices"), n, key, slice_bytes)
    attempt = uuid.uuid4().hex[:12]
    rows = spark.read.schema(todo.withColumn(SLICE, F.lit(0)).schema).parquet(staged)
    for i in range(n):
        new = generate(rows.where(F.col(SLICE) == i), fn, input_col, output_col, batch_size)
        new.select(key, output_col, *[F.lit(v).alias(k) for k, v in (tag or {}).items()]) \
            .write.mode("errorifexists").parquet(f"{checkpoint_path.rstrip('/')}/{SLICE}={attempt}-{i:06d}")
    remove_folder(spark, staged)
    return read_checkpoint(spark, checkpoint_path)
