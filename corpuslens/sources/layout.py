"""The article corpus laid out by (dataset, split), read with pruning (S1).

``split`` is computed from the id, so a filter on it can't reach the plain
``documents`` table.  ``write_layout`` stores the corpus once in a folder per
(dataset, split); afterwards a read of one split lists and opens the files of
that split only, and a join with a table of wanted (dataset, split) pairs is
pruned at run time, before files are opened.

Rows are dealt by (dataset, split, a hash of the id): a dataset with a third
of all rows is written by many tasks, and a folder gets at most
``files_per_folder`` files whatever the shuffle width.  Null datasets have a
folder of their own and are read back as null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslens.functions import segment, text
from corpuslens.sources.tables import read_table, split_of

LAYOUT_KEYS = ["dataset", "split"]
FILES_PER_FOLDER = 8


def write_layout(docs: DataFrame, path: str, carry: Sequence[str] = ("source",),
                 files_per_folder: int = FILES_PER_FOLDER) -> str:
    """Store ``docs(doc_id, text, lang, ...)``; the abstract and title are
    derived when read, so a text is stored once."""
    rows = docs.select("doc_id", *carry, F.col("text").alias("article"), F.col("lang").alias("dataset"),
                       split_of("doc_id").alias("split"))
    share = F.pmod(F.xxhash64("doc_id"), F.lit(files_per_folder))
    rows.repartition(*LAYOUT_KEYS, share).write.mode("errorifexists").partitionBy(*LAYOUT_KEYS).parquet(path)
    return path


def layout_of(spark: SparkSession, sf_dir: str, path: str) -> str:
    return write_layout(read_table(spark, sf_dir, "documents"), path)


def read_layout(spark: SparkSession, path: str, dataset: str | None = None, split: str | None = None) -> DataFrame:
    """The stored corpus; ``dataset`` and ``split`` prune folders."""
    out = spark.read.parquet(path).select(
        "doc_id", "dataset", "split", "source", segment.first_sentence("article").alias("title"), "article",
        text.abstract_of("article").alias("summary"))
    if dataset is not None:
        out = out.where(F.col("dataset") == dataset)
    if split is not None:
        out = out.where(F.col("split") == split)
    return out


def read_requested(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """The splits named in ``wanted(dataset, split)``, a stored table behind a
    filter.  Spark finds the pairs first and opens only their folders (there
    are few folders, so the pairs are sent to the scan)."""
    return read_layout(spark, path).join(F.broadcast(wanted.select(*LAYOUT_KEYS).distinct()), LAYOUT_KEYS)
