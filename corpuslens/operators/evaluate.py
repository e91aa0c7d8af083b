"""Evaluation of generated text against references, reported per model.

``eval_report`` turns (key, model, generated, reference) rows into the
ten-metric report table the ranking operators consume.  The lexical metrics
are computed here; the neural ones (METEOR, BERTScore, LENS, AlignScore,
SummaC) have no Spark form and stay null unless the caller supplies them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens import schema
from corpuslens.functions import readability as rd
from corpuslens.functions import segment
from corpuslens.operators.normalize import row_mean
from corpuslens.operators.overlap import bleu_of_sums, lowered, ngram_total, pair_counts
from corpuslens.session import bounded_batches, cut_lineage

# Fixed value: bytes of an easy-word list that may be sent to every task.
LIST_BYTES = 8 << 20
BYTES_PER_WORD = 100


def word_list(rows: DataFrame, text_col: str = "text") -> DataFrame:
    """Distinct words of a caller's table, e.g. as the Dale-Chall easy list."""
    return rows.select(F.explode(segment.words(text_col)).alias("word")).distinct()


def difficult_counts(rows: DataFrame, key: str, text_col: str, easy: DataFrame) -> DataFrame:
    """(key, n_difficult): words of ``text_col`` that are not in ``easy``.

    Words are counted per document first; the join with the list is left to
    Spark, which broadcasts it if its size allows."""
    words = rows.select(key, F.explode(segment.words(text_col)).alias("word"))
    counts = words.groupBy(key, "word").agg(F.count(F.lit(1)).alias("_c"))
    marked = counts.join(easy.withColumn("_easy", F.lit(1)), "word", "left")
    return marked.groupBy(key).agg(F.sum(F.when(F.col("_easy").isNull(), F.col("_c")).otherwise(0))
                                   .cast("bigint").alias("n_difficult"))


def doc_metrics(pairs: DataFrame, easy: DataFrame, key: str = "doc_id",
                gen_col: str = "generated", ref_col: str = "reference",
                model_col: str = "model") -> DataFrame:
    """(key, model, ROUGE, FKGL, DCRS, CLI, m1..m4, t1..t4, r_len) per pair.

    Overlaps and difficult words are counted in the pair's row.  If the easy
    list is too long to be sent to the tasks, the pairs are written once and
    the difficult words come from a join instead; the counts are the same.
    """
    spark = pairs.sparkSession
    bounded_batches(spark)
    easy = cut_lineage(easy.select("word").distinct())
    short = easy.count() * BYTES_PER_WORD <= LIST_BYTES
    listed = spark.sparkContext.broadcast({r.word for r in easy.toLocalIterator()}) if short else None
    if not short:
        pairs = cut_lineage(pairs.select(key, model_col, gen_col, ref_col))
    counts = pair_counts((1, 2, 3, 4), listed)(lowered(gen_col), lowered(ref_col))
    rows = pairs.select(key, model_col, counts.alias("_m")).select(key, model_col, "_m.*")
    rows = rows.withColumns({"n_syll": F.greatest("n_vowels", "n_words")}
                            | {f"m{n}": F.get("matched", F.lit(n - 1)) for n in (1, 2, 3, 4)}
                            | {f"t{n}": ngram_total("n_words", n) for n in (1, 2, 3, 4)}
                            | {f"_r{n}": ngram_total("n_ref", n) for n in (1, 2)}
                            | ({"n_difficult": F.when(F.col("n_words") > 0, F.col("missing"))} if short else {}))
    if not short:
        rows = rows.join(difficult_counts(pairs, key, gen_col, easy), key, "left")
    for n in (1, 2):
        rows = rows.withColumn(f"_f{n}", F.try_divide(2.0 * F.col(f"m{n}").cast("double"),
                                                      (F.col(f"t{n}") + F.col(f"_r{n}")).cast("double")))
    return rows.select(key, model_col, row_mean(["_f1", "_f2"]).alias("ROUGE"),
                       rd.flesch_kincaid_grade("n_words", "n_sents", "n_syll").alias("FKGL"),
                       rd.dale_chall("n_words", "n_sents", "n_difficult").alias("DCRS"),
                       rd.coleman_liau("n_words", "n_sents", "n_letters").alias("CLI"),
                       *[f"m{n}" for n in (1, 2, 3, 4)], *[f"t{n}" for n in (1, 2, 3, 4)],
                       F.col("_r1").alias("r_len"))


def eval_report(pairs: DataFrame, easy: DataFrame, key: str = "doc_id",
                gen_col: str = "generated", ref_col: str = "reference",
                model_col: str = "model") -> DataFrame:
    """One row per model with the ten report metrics (neural ones null), from
    one aggregation over the pairs."""
    per_doc = doc_metrics(pairs, easy, key, gen_col, ref_col, model_col)
    sums = [c for n in (1, 2, 3, 4) for c in (f"m{n}", f"t{n}")] + ["r_len"]
    rep = (per_doc.groupBy(model_col)
           .agg(*[F.avg(m).alias(m) for m in ("ROUGE", "FKGL", "DCRS", "CLI")], *[F.sum(c).alias(c) for c in sums])
           .withColumn("BLEU", bleu_of_sums()))
    cols = [F.col(model_col).alias("model")]
    for m in schema.METRICS:
        cols.append(F.col(m) if m in rep.columns else F.lit(None).cast("double").alias(m))
    return rep.select(*cols)
