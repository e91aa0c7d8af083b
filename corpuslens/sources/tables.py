"""Readers for the driver tables and the derived article corpus (S1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslens.functions import segment, text

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# How a document id maps to a split (last digit 0-7 train,
# 8 validation, 9 test).
SPLIT_OF_LAST_DIGIT = {8: "validation", 9: "test"}
DEFAULT_SPLIT = "train"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stream_path(sf_dir: str, name: str) -> str:
    """The table's path for a streaming reader, be it one file or a folder of
    part files: such a reader takes a plain path for a folder, a pattern not."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return f"{sf_dir.rstrip('/')}/{{{name}.parquet}}"


def split_of(doc_id_col) -> F.Column:
    d = F.pmod(F.col(doc_id_col) if isinstance(doc_id_col, str) else doc_id_col, F.lit(10))
    expr = F.lit(DEFAULT_SPLIT)
    for digit, name in SPLIT_OF_LAST_DIGIT.items():
        expr = F.when(d == digit, F.lit(name)).otherwise(expr)
    return expr


def corpus(spark: SparkSession, sf_dir: str, dataset: str | None = None,
           split: str | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """Article corpus view of ``documents``.

    dataset = language, split from the id, article = the text,
    summary = its first line (the abstract), title = its first sentence.
    Filters on ``dataset``/``split`` are plain predicates, so the language
    filter reaches the Parquet scan.  ``carry`` names further columns to keep.
    """
    docs = read_table(spark, sf_dir, "documents")
    if dataset is not None:
        docs = docs.where(F.col("lang") == dataset)
    out = docs.select(
        "doc_id",
        F.col("lang").alias("dataset"),
        split_of("doc_id").alias("split"),
        segment.first_sentence("text").alias("title"),
        F.col("text").alias("article"),
        text.abstract_of("text").alias("summary"),
        *carry,
    )
    if split is not None:
        out = out.where(F.col("split") == split)
    return out
