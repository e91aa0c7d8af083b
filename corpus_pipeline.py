"""Documents to training sequences in five stages.

Each stage takes what the one before kept, applies one operator of
``corpuslens.llm`` and returns a DataFrame that is written as Parquet before
the next stage reads it:

1. language ID: documents that are in none of the learned languages go;
2. exact dedup: of equal texts (but for white space) one stays;
3. SimHash near-dedup: of each group of near copies one stays;
4. mixing: every document as often as its source's target asks for;
5. packing: the pieces of all documents placed into sequences.

All but the last return the columns of ``documents``.  An empty table passes
through; nulls are treated as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpuslens.llm import exact, langid, mixing, packing, simhash
from corpuslens.session import scratch_dir


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_accepted(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.keep_owners(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_rows(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("simhash_dedup", simhash_dedup),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

#: language models, fingerprints' classes and best-fit packing are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
