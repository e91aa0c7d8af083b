"""Lexical evaluation metrics as queries: ROUGE-N per pair, corpus BLEU per
model, Dale-Chall per document (easy words from the benchmark table)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuslens.functions import readability as rd
from corpuslens.operators import evaluate, overlap
from corpuslens.plans import sqlfrag as q
from corpuslens.plans.evaluation import (SQL_EASY, _sql_overlap, _sql_pairs, _sql_report, easy_list,
                                         generation_pairs, sql_pairs_select)
from corpuslens.plans.registry import query, r6
from corpuslens.sources.tables import read_table


@query("rouge_n", "with " + _sql_pairs(sql_pairs_select()) + ", " + _sql_overlap((1, 2))
       + " select pid, cast(n as integer) as n, "
       + q.r6("case when gen_total = 0 then null else matched / gen_total end") + " as precision, "
       + q.r6("case when ref_total = 0 then null else matched / ref_total end") + " as recall, "
       + q.r6("case when gen_total + ref_total = 0 then null else 2.0 * matched / (gen_total + ref_total) end")
       + " as f1 from ov")
def q_rouge_n(spark, sf_dir):
    pairs = generation_pairs(spark, sf_dir)
    r = overlap.rouge_n(pairs, "pid", "generated", "reference", (1, 2))
    return r.select("pid", F.col("n").cast("int").alias("n"),
                    r6("precision").alias("precision"), r6("recall").alias("recall"), r6("f1").alias("f1"))


@query("bleu_corpus", _sql_report() + f" select model, {q.r6('BLEU')} as bleu from bleu")
def q_bleu_corpus(spark, sf_dir):
    pairs = generation_pairs(spark, sf_dir)
    ov = overlap.ngram_overlap(pairs, "pid", "generated", "reference", (1, 2, 3, 4), carry=["model"])
    return overlap.bleu_from_overlap(ov, ["model"]).select("model", r6("bleu").alias("bleu"))


@query("dale_chall",
       f"with {SQL_EASY}, "
       f"ww as (select doc_id, unnest({q.words('text')}) as word from documents), "
       "hard as (select ww.doc_id, sum(case when e.word is null then 1 else 0 end) as d "
       "from ww left join easy e on ww.word = e.word group by ww.doc_id), "
       f"c as (select doc_id, len({q.words('text')}) as w, len({q.sentences('text')}) as s from documents) "
       "select c.doc_id, cast(c.w as bigint) as n_words, cast(c.s as bigint) as n_sents, "
       "cast(h.d as bigint) as n_difficult, "
       + q.r6("case when c.w > 0 then (case when (h.d / c.w) * 100.0 > 5.0 then 0.1579 * ((h.d / c.w) * 100.0) "
              "+ 0.0496 * (c.w / nullif(c.s, 0)) + 3.6365 else 0.1579 * ((h.d / c.w) * 100.0) "
              "+ 0.0496 * (c.w / nullif(c.s, 0)) end) end")
       + " as dcrs from c left join hard h on h.doc_id = c.doc_id")
def q_dale_chall(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    hard = evaluate.difficult_counts(docs, "doc_id", "text", easy_list(spark, sf_dir))
    counts = rd.with_counts(docs, "text")
    out = counts.join(hard, "doc_id", "left")
    return out.select("doc_id", "n_words", "n_sents", "n_difficult",
                      r6(rd.dale_chall("n_words", "n_sents", "n_difficult")).alias("dcrs"))
