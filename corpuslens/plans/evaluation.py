"""Evaluation and ranking queries over the corpus (jobs: evaluate, rank).

What is evaluated is the extractor's own output: ``reference`` = the abstract
(first line), ``generated`` = the body's best 10, 20, 30 or 40 sentences.  The
easy words of the Dale-Chall score are those of the ``benchmark`` table, so
the score of a text does not depend on the other documents.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslens import schema
from corpuslens.operators import evaluate, extract, normalize, rank
from corpuslens.options import SUMMARY_LENGTHS, Variant
from corpuslens.plans import sqlfrag as q
from corpuslens.plans.extract import sql_summaries
from corpuslens.plans.registry import query, r6
from corpuslens.sources.tables import corpus, read_table

EVALUATED = Variant("body", ranked=True)
RUN_PREFIX = "extract_"


def generation_pairs(spark: SparkSession, sf_dir: str, lengths: Sequence[int] = SUMMARY_LENGTHS,
                     naming: str = "run") -> DataFrame:
    """(pid, model, reference, generated) for the extractor's summaries.

    naming "source": model = source, pid = doc_id (one length only);
    "run": model = extract_<source>_<n>; "method": model = extract_<n>; for
    these pid = '<doc_id>#<n>', and one ranking serves all lengths.
    """
    if naming == "source" and len(lengths) != 1:
        raise ValueError("naming='source' takes exactly one length")
    docs = corpus(spark, sf_dir, carry=["source"])
    long = extract.extract_long(extract.extract_wide(docs, EVALUATED, lengths=lengths, carry=["source"]), lengths=lengths)
    n = F.col("n_sentences").cast("string")
    model = {"source": F.col("source"), "run": F.concat(F.lit(RUN_PREFIX), "source", F.lit("_"), n),
             "method": F.concat(F.lit(RUN_PREFIX), n)}[naming]
    pid = F.col("doc_id") if naming == "source" else F.concat(F.col("doc_id").cast("string"), F.lit("#"), n)
    return long.select(pid.alias("pid"), model.alias("model"), F.col("summary").alias("reference"),
                       F.col("transformed").alias("generated"))


def easy_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.word_list(read_table(spark, sf_dir, "benchmark"))


def corpus_report(spark: SparkSession, sf_dir: str, lengths: Sequence[int] = SUMMARY_LENGTHS,
                  naming: str = "run") -> DataFrame:
    return evaluate.eval_report(generation_pairs(spark, sf_dir, lengths, naming), easy_list(spark, sf_dir), key="pid")


def _round_doubles(df: DataFrame) -> DataFrame:
    return df.select(*[r6(F.col(f"`{f.name}`")).alias(f.name) if f.dataType.typeName() == "double"
                       else F.col(f"`{f.name}`") for f in df.schema.fields])


# --------------------------------------------------------------------------
# SQL oracle pieces
# --------------------------------------------------------------------------
SQL_EASY = f"easy as (select distinct unnest({q.words('text')}) as word from benchmark)"


def sql_pairs_select(lengths: Sequence[int] = SUMMARY_LENGTHS, naming: str = "run") -> str:
    """SELECT (pid, model, reference, generated) of ``generation_pairs``."""
    def one(n):
        pid = "doc_id" if naming == "source" else f"cast(doc_id as varchar) || '#{n}'"
        model = {"source": "source", "run": f"'{RUN_PREFIX}' || source || '_{n}'", "method": f"'{RUN_PREFIX}{n}'"}[naming]
        return (f"select {pid} as pid, {model} as model, summary as reference, extracted_summary_{n} as generated "
                "from wide")
    return sql_summaries(EVALUATED) + " " + " union all ".join(map(one, lengths))


def _sql_pairs(pairs_sql: str) -> str:
    return (f"pairs as ({pairs_sql}), "
            f"pw as (select pid, model, generated, {q.words('generated')} as gw, "
            f"{q.words('reference')} as rw from pairs)")


def _sql_overlap(ns=(1, 2, 3, 4)) -> str:
    grams = " union all ".join(
        f"select pid, {n} as n, unnest({q.ngrams(w, n)}) as gram, {side} as side from pw"
        for n in ns for side, w in ((0, "gw"), (1, "rw")))
    nlist = ", ".join(str(n) for n in ns)
    return (f"grams as ({grams}), "
            f"gcnt as (select pid, n, gram, sum(case when side = 0 then 1 else 0 end) as c_gen, "
            f"sum(case when side = 1 then 1 else 0 end) as c_ref from grams group by pid, n, gram), "
            f"gm as (select pid, n, sum(least(c_gen, c_ref)) as matched from gcnt group by pid, n), "
            f"ov as (select pw.pid, pw.model, ns.n, coalesce(gm.matched, 0) as matched, "
            f"greatest(len(gw) - ns.n + 1, 0) as gen_total, greatest(len(rw) - ns.n + 1, 0) as ref_total "
            f"from pw cross join (select unnest([{nlist}]) as n) ns "
            f"left join gm on gm.pid = pw.pid and gm.n = ns.n)")


def _sql_f1(n: int) -> str:
    return (f"max(case when n = {n} then (case when gen_total + ref_total = 0 then null "
            f"else 2.0 * matched / (gen_total + ref_total) end) end)")


def _sql_report(pairs_sql: str | None = None) -> str:
    """``with ... report as (...)``: the ten-metric report per model."""
    pairs_sql = pairs_sql or sql_pairs_select()
    return (
        "with " + _sql_pairs(pairs_sql) + ", " + _sql_overlap() + ", "
        f"rg as (select pid, {_sql_f1(1)} as rouge1, {_sql_f1(2)} as rouge2 from ov group by pid), "
        f"cnt as (select pid, model, len(gw) as w, len({q.sentences('generated')}) as s, "
        f"greatest({q.vowel_groups('generated')}, len(gw)) as y, "
        f"length(array_to_string(gw, '')) as l from pw), "
        + SQL_EASY + ", "
        f"gwords as (select pid, unnest(gw) as word from pw), "
        f"hard as (select g.pid, sum(case when e.word is null then 1 else 0 end) as d "
        f"from gwords g left join easy e on g.word = e.word group by g.pid), "
        f"per_doc as (select c.pid, c.model, {q.row_mean(['rg.rouge1', 'rg.rouge2'])} as rouge, "
        f"case when w > 0 then 0.39 * (w / nullif(s, 0)) + 11.8 * (y / w) - 15.59 end as fkgl, "
        f"case when w > 0 then (case when (h.d / w) * 100.0 > 5.0 "
        f"then 0.1579 * ((h.d / w) * 100.0) + 0.0496 * (w / nullif(s, 0)) + 3.6365 "
        f"else 0.1579 * ((h.d / w) * 100.0) + 0.0496 * (w / nullif(s, 0)) end) end as dcrs, "
        f"case when w > 0 then 0.0588 * ((l / w) * 100.0) - 0.296 * ((s / w) * 100.0) - 15.8 end as cli "
        f"from cnt c left join rg on rg.pid = c.pid left join hard h on h.pid = c.pid), "
        f"means as (select model, avg(rouge) as ROUGE, avg(fkgl) as FKGL, avg(dcrs) as DCRS, "
        f"avg(cli) as CLI from per_doc group by model), "
        f"bs as (select model, "
        + ", ".join(f"sum(case when n = {n} then matched end) as m{n}, "
                    f"sum(case when n = {n} then gen_total end) as t{n}" for n in (1, 2, 3, 4))
        + ", sum(case when n = 1 then ref_total end) as r_len from ov group by model), "
        f"bleu as (select model, case when t1 is null or t1 = 0 then null "
        f"when m1 = 0 or m2 = 0 or m3 = 0 or m4 = 0 then 0.0 "
        f"else 100.0 * (case when t1 > r_len then 1.0 else exp(1.0 - r_len / t1) end) * "
        f"exp((ln(m1 / t1) + ln(m2 / t2) + ln(m3 / t3) + ln(m4 / t4)) / 4.0) end as BLEU from bs), "
        f"report as (select m.model, m.ROUGE, b.BLEU, cast(null as double) as METEOR, "
        f"cast(null as double) as BERTScore, m.FKGL, m.DCRS, m.CLI, cast(null as double) as LENS, "
        f"cast(null as double) as AlignScore, cast(null as double) as SummaC "
        f"from means m left join bleu b on b.model = m.model)"
    )


def _sql_normalized(rule: str, src: str = "report", lower=schema.LOWER_IS_BETTER,
                    metrics=schema.METRICS, keep=("model",), flip_after: bool = False) -> str:
    cols = []
    for m in metrics:
        lo, hi = f"min({m}) over ()", f"max({m}) over ()"
        down = m in lower and not flip_after
        scaled = f"({hi} - {m}) / nullif({hi} - {lo}, 0)" if down else f"({m} - {lo}) / nullif({hi} - {lo}, 0)"
        if rule == "null":
            v = scaled
        elif rule == "zero":
            v = f"case when {hi} = {lo} then 0.0 else {scaled} end"
        else:
            v = f"case when {hi} > {lo} then {scaled} else 0.5 end"
        if flip_after and m in lower:
            v = f"1.0 - ({v})"
        cols.append(f"{v} as {m}")
    return f"select {', '.join(keep)}, {', '.join(cols)} from {src}"


def _sql_categories(src: str, names=("relevance", "readability", "factuality", "score")) -> str:
    rel, rea, fac, fin = names
    return (f"select *, {q.row_mean([rel, rea, fac])} as {fin} from (select *, "
            f"{q.row_mean(schema.RELEVANCE)} as {rel}, {q.row_mean(schema.READABILITY)} as {rea}, "
            f"{q.row_mean(schema.FACTUALITY)} as {fac} from {src})")


def _sql_select_r6(cols, src, text_cols=("model",)) -> str:
    return "select " + ", ".join(c if c in text_cols else f"{q.r6(c)} as {c}" for c in cols) + f" from {src}"


# --------------------------------------------------------------------------
# Queries
# --------------------------------------------------------------------------
@query("eval_report", _sql_report() + " " + _sql_select_r6(["model"] + schema.METRICS, "report"))
def q_eval_report(spark, sf_dir):
    return _round_doubles(corpus_report(spark, sf_dir))


def rank_report(report: DataFrame) -> DataFrame:
    """N1 normalization -> category means -> score, sorted best first."""
    norm = normalize.minmax_normalize(report, schema.METRICS, schema.LOWER_IS_BETTER, "null")
    scored = normalize.category_means(norm)
    return rank.sort_by_score(scored, "score").select(*schema.RANKING_COLUMNS)


@query("rank_evals", _sql_report() + ", norm as (" + _sql_normalized("null") + "), "
       + "cat as (" + _sql_categories("norm") + ") "
       + _sql_select_r6(schema.RANKING_COLUMNS, "cat"))
def q_rank_evals(spark, sf_dir):
    return _round_doubles(rank_report(corpus_report(spark, sf_dir)))


@query("normalize_report", _sql_report() + " " + _sql_select_r6(["model"] + schema.METRICS,
                                                                 "(" + _sql_normalized("null") + ")"))
def q_normalize_report(spark, sf_dir):
    rep = corpus_report(spark, sf_dir)
    return _round_doubles(normalize.minmax_normalize(rep, schema.METRICS, schema.LOWER_IS_BETTER, "null"))


@query("metric_ranges", _sql_report() + " select "
       + ", ".join(f"{q.r6(f'min({m})')} as {m}__min, {q.r6(f'max({m})')} as {m}__max" for m in schema.METRICS)
       + " from report")
def q_metric_ranges(spark, sf_dir):
    rep = normalize.nan_to_null(corpus_report(spark, sf_dir), schema.METRICS)
    return _round_doubles(normalize.metric_ranges(rep, schema.METRICS))


@query("category_means", _sql_report() + " " + _sql_select_r6(
    ["model", "relevance", "readability", "factuality", "score"], "(" + _sql_categories("report") + ")"))
def q_category_means(spark, sf_dir):
    rep = normalize.category_means(corpus_report(spark, sf_dir))
    return _round_doubles(rep.select("model", "relevance", "readability", "factuality", "score"))
