"""Evaluation-table queries: report folders, run-name parsing, recoding,
notebook/leaderboard normalization, difference and pairwise comparison.

Inputs are reports Spark computes from the corpus: a *run* is one source
summarized to its best 10, 20, 30 or 40 sentences (``extract_<source>_<n>``),
a *method* is the whole corpus at one length (``extract_<n>``).  Folder-based
queries write those reports with Spark into the session's shared checkpoint
folder and read them back through the report readers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens import schema
from corpuslens.operators import bootstrap, compare, normalize, rank, reshape
from corpuslens.options import SUMMARY_LENGTHS
from corpuslens.plans import sqlfrag as q
from corpuslens.plans.evaluation import (RUN_PREFIX, _round_doubles, _sql_categories, _sql_normalized, _sql_report,
                                         corpus_report, rank_report, sql_pairs_select)
from corpuslens.plans.registry import query
from corpuslens.session import cut_lineage, scratch_dir
from corpuslens.sources import reports, sinks
from corpuslens.sources.tables import read_table

METHOD_A, METHOD_B = SUMMARY_LENGTHS[0], SUMMARY_LENGTHS[2]
NAME_A, NAME_B = f"{RUN_PREFIX}{METHOD_A}", f"{RUN_PREFIX}{METHOD_B}"
NOTEBOOK_NAMES = ("avg_relevance", "avg_readability", "avg_factuality", "score")
LEADERBOARD_NAMES = ("Relevance", "Readability", "Factuality", "Final")


def model_labels(spark, sf_dir) -> DataFrame:
    """(run_model, label): display names of the runs' models, from the data.
    The first source has none, as a label table may lack a model."""
    sources = read_table(spark, sf_dir, "documents").select("source").distinct()
    first = sources.select(F.min("source")).scalar()
    return sources.where(F.col("source") > first).select(
        F.concat(F.lit(RUN_PREFIX), "source").alias("run_model"), F.concat(F.lit("Extract of "), "source").alias("label"))


_SQL_RUNS = _sql_report(sql_pairs_select(SUMMARY_LENGTHS, "run"))
_SQL_METHODS = _sql_report(sql_pairs_select((METHOD_A, METHOD_B), "method"))
_SQL_NAMED = (
    ", named as (select replace(model, '_' || split_part(model, '_', -1), '') as model, "
    "cast(split_part(model, '_', -1) as integer) as count, "
    + ", ".join(schema.METRICS) + f" from report where starts_with(model, '{RUN_PREFIX}'))"
)
_SQL_LABELS = (f"(select '{RUN_PREFIX}' || source as k, 'Extract of ' || source as v from "
               "(select distinct source from documents) where source > (select min(source) from documents)) as lab")
_SQL_RECODED = (
    _SQL_NAMED + f", recoded as (select lab.v as model, n.count, "
    + ", ".join(f"n.{m}" for m in schema.METRICS)
    + f" from named n left join {_SQL_LABELS} on lab.k = n.model)"
)


def runs_report(spark, sf_dir) -> DataFrame:
    return corpus_report(spark, sf_dir, SUMMARY_LENGTHS, "run")


def methods_report(spark, sf_dir) -> DataFrame:
    return corpus_report(spark, sf_dir, (METHOD_A, METHOD_B), "method")


def named_runs(spark, sf_dir) -> DataFrame:
    """Write the runs as a report folder, read it back with prefix + name parsing."""
    path = scratch_dir(spark, "runs-json")
    reports.write_reports_json(runs_report(spark, sf_dir), path, "model")
    df = reports.read_eval_reports(spark, path, prefix=RUN_PREFIX, key="dir")
    model, count = reports.parse_run_name(F.col("model"))
    return df.select(model.alias("model"), count.alias("count"), *schema.METRICS)


def recoded_runs(spark, sf_dir) -> DataFrame:
    """Runs under their display names; a model without one becomes null."""
    df = named_runs(spark, sf_dir)
    return (df.join(model_labels(spark, sf_dir), F.col("model") == F.col("run_model"), "left")
            .select(F.col("label").alias("model"), "count", *schema.METRICS))


def notebook_ranking(df: DataFrame) -> DataFrame:
    metric_cols = [c for c in df.columns if c not in ("model", "count")]
    norm = normalize.minmax_normalize(df, metric_cols, schema.LOWER_IS_BETTER, "half")
    scored = normalize.category_means(norm, NOTEBOOK_NAMES)
    return rank.sort_by_score(scored, "score")


@query("eval_json_scan", _sql_report() + " select model, "
       + ", ".join(f"{q.r6(m)} as {m}" for m in schema.METRICS) + " from report")
def q_eval_json_scan(spark, sf_dir):
    path = scratch_dir(spark, "report-json")
    reports.write_reports_json(corpus_report(spark, sf_dir), path, "model")
    return _round_doubles(reports.read_eval_reports(spark, path, key="dir"))


@query("eval_json_flat", _sql_report() + " select model, "
       + ", ".join(f"{q.r6(m)} as {m}" for m in schema.METRICS) + " from report")
def q_eval_json_flat(spark, sf_dir):
    """S4: a flat folder whose file stems are the keys."""
    path = scratch_dir(spark, "report-flat")
    reports.write_reports_flat(corpus_report(spark, sf_dir), path, "model")
    return _round_doubles(reports.read_eval_reports(spark, path, key="stem"))


@query("ranking_report", _sql_report() + ", norm as (" + _sql_normalized("null") + "), cat as ("
       + _sql_categories("norm") + f") select model, {q.r6('score')} as score from cat")
def q_ranking_report(spark, sf_dir):
    """K9: the ranking written as an ordered CSV report, and read back."""
    path = scratch_dir(spark, "ranking-report")
    sinks.write_ranking_report(rank_report(corpus_report(spark, sf_dir)).select("model", "score"), path)
    return _round_doubles(spark.read.option("header", True).schema("model string, score double").csv(path))


@query("eval_json_named", _SQL_RUNS + _SQL_NAMED + " select model, count, "
       + ", ".join(f"{q.r6(m)} as {m}" for m in schema.METRICS) + " from named")
def q_eval_json_named(spark, sf_dir):
    return _round_doubles(named_runs(spark, sf_dir))


@query("recode_models", _SQL_RUNS + _SQL_RECODED + " select model, count from recoded")
def q_recode_models(spark, sf_dir):
    return recoded_runs(spark, sf_dir).select("model", "count")


_SQL_NB = (_SQL_RUNS + _SQL_RECODED + ", nb as ("
           + _sql_normalized("half", "recoded", keep=("model", "count")) + "), nbc as ("
           + _sql_categories("nb", NOTEBOOK_NAMES) + ")")


@query("normalize_notebook", _SQL_NB + " select model, count, "
       + ", ".join(f"{q.r6(c)} as {c}" for c in schema.METRICS + list(NOTEBOOK_NAMES)) + " from nbc")
def q_normalize_notebook(spark, sf_dir):
    return _round_doubles(notebook_ranking(recoded_runs(spark, sf_dir)))


@query("score_curve", _SQL_NB + f" select model, count, {q.r6('avg(score)')} as score from nbc "
       "group by model, count order by count, model")
def q_score_curve(spark, sf_dir):
    nb = notebook_ranking(recoded_runs(spark, sf_dir))
    curve = nb.groupBy("model", "count").agg(F.avg("score").alias("score")).orderBy("count", "model")
    return _round_doubles(curve)


@query("score_curve_band", _SQL_NB + ", nk as (select *, coalesce(model, '') as who from nbc), "
       + bootstrap.sql_band("nk", "who", ["count"], "score")
       + f" select count, n, {q.r6('mean')} as mean, {q.r6('low')} as low, {q.r6('high')} as high from band order by count")
def q_score_curve_band(spark, sf_dir):
    """The mean score at every length with its 95 % band over the models."""
    nb = notebook_ranking(recoded_runs(spark, sf_dir))
    return _round_doubles(bootstrap.confidence_band(nb, "model", ["count"], "score").orderBy("count"))


# -- leaderboard -------------------------------------------------------------
_TASK_2 = "SubTask 2.1"


def leaderboard_rows(report: DataFrame) -> DataFrame:
    """Leaderboard-shaped rows from a runs report (task by summary length)."""
    model, count = reports.parse_run_name(F.col("model"))
    cols = {
        "#": F.lit(None).cast("bigint"), "Participant": F.col("model"),
        "Entries": count.cast("bigint"), "Date": F.lit(None).cast("string"),
        "ID": F.lit(None).cast("bigint"),
        "Select Task": F.when(count <= METHOD_B, F.lit(schema.LEADERBOARD_TASK)).otherwise(F.lit(_TASK_2)),
        "Team Name": model,
    }
    for c in schema.LEADERBOARD_COLUMNS[7:]:
        base = c.replace("(Task1)", "")
        cols[c] = F.col(base) if base in schema.METRICS else F.lit(None).cast("double")
    return report.select(*[v.alias(k) for k, v in cols.items()])


def leaderboard(spark, sf_dir) -> DataFrame:
    path = scratch_dir(spark, "leaderboard-csv")
    reports.write_leaderboard_csv(leaderboard_rows(runs_report(spark, sf_dir)), path)
    return reports.read_leaderboard(spark, path)


def leaderboard_ranking(board: DataFrame) -> DataFrame:
    sub = board.where(F.col("`Select Task`") == schema.LEADERBOARD_TASK)
    norm = normalize.minmax_normalize(sub, schema.LEADERBOARD_SCORES, schema.LOWER_IS_BETTER,
                                      "zero", flip_after=True)
    scored = normalize.category_means(norm, LEADERBOARD_NAMES,
                                      (schema.LEADERBOARD_RELEVANCE, schema.LEADERBOARD_READABILITY,
                                       schema.LEADERBOARD_FACTUALITY))
    return rank.sort_by_score(scored, "Final", "Participant")


def _qi(c: str) -> str:
    return '"' + c + '"'


_SQL_BOARD = (
    _SQL_RUNS + ", board as (select cast(null as bigint) as " + _qi("#") + ", model as " + _qi("Participant")
    + ", cast(split_part(model, '_', -1) as bigint) as " + _qi("Entries")
    + ", cast(null as varchar) as " + _qi("Date") + ", cast(null as bigint) as " + _qi("ID")
    + f", case when cast(split_part(model, '_', -1) as integer) <= {METHOD_B} then '{schema.LEADERBOARD_TASK}' "
    f"else '{_TASK_2}' end as " + _qi("Select Task")
    + ", replace(model, '_' || split_part(model, '_', -1), '') as " + _qi("Team Name") + ", "
    + ", ".join((m if m in schema.METRICS else "cast(null as double)") + " as " + _qi(c)
                for c, m in ((c, c.replace("(Task1)", "")) for c in schema.LEADERBOARD_COLUMNS[7:]))
    + " from report)"
)


@query("leaderboard_scan", _SQL_BOARD + " select " + ", ".join(
    (f"{q.r6(_qi(c))} as {_qi(c)}" if c in schema.LEADERBOARD_SCORES or c.endswith("(Task2)") else _qi(c))
    for c in schema.LEADERBOARD_COLUMNS) + " from board")
def q_leaderboard_scan(spark, sf_dir):
    return _round_doubles(leaderboard(spark, sf_dir))


def _sql_lb_rank() -> str:
    cols = []
    for c in schema.LEADERBOARD_SCORES:
        x = _qi(c)
        lo, hi = f"min({x}) over ()", f"max({x}) over ()"
        v = f"case when {hi} = {lo} then 0.0 else ({x} - {lo}) / nullif({hi} - {lo}, 0) end"
        if c in schema.LOWER_IS_BETTER:
            v = f"1.0 - ({v})"
        cols.append(f"{v} as {x}")
    rel = q.row_mean([_qi(c) for c in schema.LEADERBOARD_RELEVANCE])
    rea = q.row_mean([_qi(c) for c in schema.LEADERBOARD_READABILITY])
    fac = q.row_mean([_qi(c) for c in schema.LEADERBOARD_FACTUALITY])
    return (f", sub as (select * from board where {_qi('Select Task')} = '{schema.LEADERBOARD_TASK}'), "
            f"lbn as (select {_qi('Participant')}, {', '.join(cols)} from sub), "
            f"lbc as (select *, {rel} as Relevance, {rea} as Readability, {fac} as Factuality from lbn), "
            f"lbf as (select *, {q.row_mean(['Relevance', 'Readability', 'Factuality'])} as Final from lbc)")


_LB_OUT = ["Participant"] + schema.LEADERBOARD_SCORES + list(LEADERBOARD_NAMES)


@query("leaderboard_rank", _SQL_BOARD + _sql_lb_rank() + " select " + ", ".join(
    _qi(c) if c == "Participant" else f"{q.r6(_qi(c))} as {_qi(c)}" for c in _LB_OUT) + " from lbf")
def q_leaderboard_rank(spark, sf_dir):
    return _round_doubles(leaderboard_ranking(leaderboard(spark, sf_dir)).select(*[F.col(f"`{c}`") for c in _LB_OUT]))


# -- two-method comparison -----------------------------------------------------
def method_pair(spark, sf_dir):
    # a row per method; cut, or every side of a comparison would evaluate the corpus again
    rep = cut_lineage(methods_report(spark, sf_dir))
    long = reshape.metrics_long(rep, "model", schema.METRICS)
    a = long.where(F.col("model") == NAME_A).select("metric", F.col("value").alias("a"))
    b = long.where(F.col("model") == NAME_B).select("metric", F.col("value").alias("b"))
    return a, b


_SQL_LONG = (_SQL_METHODS + ", long as (" + " union all ".join(
    f"select model, '{m}' as metric, {m} as value from report where {m} is not null" for m in schema.METRICS)
    + f"), ma as (select metric, value as a from long where model = '{NAME_A}'), "
    f"mb as (select metric, value as b from long where model = '{NAME_B}')")
_SQL_ORDER = "(values " + ", ".join(f"({i + 1}, '{m}')" for i, m in enumerate(schema.METRICS)) + ") as o(ord, metric)"


@query("diff_evals", _SQL_LONG + ", ab as (select coalesce(ma.metric, mb.metric) as metric, a, b "
       "from ma full outer join mb on ma.metric = mb.metric) "
       f"select cast(o.ord as integer) as ord, o.metric, {q.r6('ab.a')} as a, {q.r6('ab.b')} as b, "
       f"{q.r6('ab.b - ab.a')} as diff from {_SQL_ORDER} left join ab on ab.metric = o.metric")
def q_diff_evals(spark, sf_dir):
    a, b = method_pair(spark, sf_dir)
    return _round_doubles(compare.diff_table(a, b, schema.METRICS))


@query("metric_intersect", _SQL_LONG + " select ma.metric from ma join mb on ma.metric = mb.metric")
def q_metric_intersect(spark, sf_dir):
    a, b = method_pair(spark, sf_dir)
    return compare.common_metrics(a, b)


@query("pairwise_wins", _SQL_LONG + ", c as (select ma.metric, a, b, "
       f"case when ma.metric in ({', '.join(repr(m) for m in schema.LOWER_IS_BETTER)}) then a < b else a > b end as a_wins "
       "from ma join mb on ma.metric = mb.metric), "
       "t as (select count(*) as n_common, sum(case when a_wins then 1 else 0 end) as wins_a, "
       "sum(case when a <> b and not a_wins then 1 else 0 end) as wins_b from c) "
       f"select cast(n_common as bigint) as n_common, cast(wins_a as bigint) as wins_a, "
       f"cast(wins_b as bigint) as wins_b, case when wins_a > wins_b then '{NAME_A}' "
       f"when wins_b > wins_a then '{NAME_B}' else 'Tie' end as verdict from t")
def q_pairwise_wins(spark, sf_dir):
    a, b = method_pair(spark, sf_dir)
    return compare.pairwise_wins(a, b, schema.LOWER_IS_BETTER, NAME_A, NAME_B)


_SQL_PLONG = (_SQL_LONG + ", pl as (select ma.metric, '" + NAME_A + "' as method, a as value "
              "from ma join mb on ma.metric = mb.metric union all select mb.metric, '" + NAME_B
              + "' as method, b as value from ma join mb on ma.metric = mb.metric)")


@query("pairwise_long", _SQL_PLONG + f" select metric, method, {q.r6('value')} as value from pl")
def q_pairwise_long(spark, sf_dir):
    a, b = method_pair(spark, sf_dir)
    return _round_doubles(compare.pairwise_long(a, b, NAME_A, NAME_B))


@query("metric_bars", _SQL_PLONG + f" select metric, method, {q.r6('avg(value)')} as value "
       "from pl group by metric, method")
def q_metric_bars(spark, sf_dir):
    a, b = method_pair(spark, sf_dir)
    pl = compare.pairwise_long(a, b, NAME_A, NAME_B)
    return _round_doubles(pl.groupBy("metric", "method").agg(F.avg("value").alias("value")))


# -- inline records ------------------------------------------------------------
@query("inline_json_records",
       "select event_id, cast(json_extract(props, '$.k') as integer) as k, "
       "cast(json_extract(props, '$.k') as integer) as k_single_quoted from events")
def q_inline_json_records(spark, sf_dir):
    from pyspark.sql import types as T
    ev = read_table(spark, sf_dir, "events").select("event_id", "props")
    sch = T.StructType([T.StructField("k", T.IntegerType(), True)])
    py_style = F.translate(F.col("props"), '"', "'")
    return ev.select("event_id",
                     reports.parse_records("props", sch, single_quotes=False).getField("k").alias("k"),
                     reports.parse_records(py_style, sch).getField("k").alias("k_single_quoted"))
