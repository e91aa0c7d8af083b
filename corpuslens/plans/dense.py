"""Dense sentence and document vectors from an encoder trained on the corpus."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuslens.operators import extract, latent, vectors
from corpuslens.plans.registry import query, r6
from corpuslens.session import cut_lineage, release, scratch_dir
from corpuslens.sources.tables import read_table

RANK, OVERSAMPLE, POWER_STEPS = 16, 8, 1


def _fitted(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    path = scratch_dir(spark, "cells")
    idf = vectors.idf_table(docs, "doc_id", "text")
    weights = idf, *vectors.sent_idf(idf)
    (extract.document_terms(docs, "doc_id", "text", weights).select("doc_id", "term", "idf", "w")
     .write.option("compression", "zstd").parquet(path))
    cells = spark.read.parquet(path)
    encoder, strength = latent.fit(cells, "doc_id", RANK, OVERSAMPLE, POWER_STEPS)
    return docs, cells, encoder, strength, weights


def _trained(spark, sf_dir):
    return _fitted(spark, sf_dir)[:4]


def _sentence_vectors(docs, encoder, dimensions, frequent, weights):
    """(doc_id, pos, vector) of every sentence."""
    keys, (idf, sent, every) = ["doc_id", "pos"], weights

    def vectors_of(rows, together):
        sentences = extract.sentence_rows(rows, "doc_id", "text")
        tf = vectors.row_counts(sentences, keys, "sentence", sent) if every else vectors.with_idf(
            vectors.row_counts(sentences, keys, "sentence"), idf)
        cells = tf.select(*keys, "term", (F.col("tf") * F.col("idf")).alias("w"))
        return latent.text_vectors(cells, keys, encoder, dimensions, frequent, together and every)

    # sentences of documents that have several rows are added up
    once, several = vectors.by_rows(docs, "doc_id")
    found = vectors_of(once, True)
    return found if several is None else found.unionByName(vectors_of(several, False))


@query("dense_document_vectors")
def q_dense_document_vectors(spark, sf_dir):
    """Every document's vector length and its share of the full TF-IDF length."""
    _, cells, encoder, strength = _trained(spark, sf_dir)
    vec = latent.text_vectors(cells, ["doc_id"], encoder, len(strength), latent.frequent_terms(cells))
    full = cells.groupBy("doc_id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("full"))
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    return vec.join(full, "doc_id").select("doc_id", r6(norm).alias("norm"), r6(norm / F.col("full")).alias("kept"))


@query("dense_sentence_cosine")
def q_dense_sentence_cosine(spark, sf_dir):
    """Cosine of every sentence to its document, on trained dense vectors."""
    docs, cells, encoder, strength, weights = _fitted(spark, sf_dir)
    frequent = latent.frequent_terms(cells)
    whole = latent.text_vectors(cells, ["doc_id"], encoder, len(strength), frequent).withColumnRenamed("vector", "whole")
    whole = latent.sized(cut_lineage(whole), len(strength))
    release(spark)
    one = _sentence_vectors(docs, encoder, len(strength), frequent, weights)
    return one.join(whole, "doc_id").select("doc_id", F.col("pos").cast("bigint").alias("pos"),
                                            r6(vectors.dense_cosine("vector", "whole")).alias("cosine"))
