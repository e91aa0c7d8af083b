"""Phrase ranking and summaries by distance to the phrase vector."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuslens.operators import phrases as P
from corpuslens.operators import textrank as TR
from corpuslens.options import CANDIDATE_LIMIT
from corpuslens.plans.extract import _sql_edges, _sql_pagerank, _sql_sents
from corpuslens.plans import sqlfrag as q
from corpuslens.plans.registry import query
from corpuslens.sources.tables import read_table

_N = P.PHRASE_WORDS
_SQL = ("with rin as (select doc_id, text from documents), " + _sql_sents() + ", " + _sql_edges("rin") + ", " + _sql_pagerank()
        + f", ru as (select doc_id, pos, string_split(unnest(regexp_extract_all(lower(sentence), '{q.plain(P.RUN)}')), ' ') as w from sents), "
        f"ph as materialized (select distinct doc_id, pos, array_to_string(w[i:i + {_N - 1}], ' ') as phrase "
        f"from (select doc_id, pos, w, unnest(range(1, len(w) + 1, {_N})) as i from ru)), "
        "pw as (select doc_id, phrase, unnest(string_split(phrase, ' ')) as word from (select distinct doc_id, phrase from ph)), "
        f"ps as (select pw.doc_id, phrase, round(sqrt(sum(coalesce(r, 0)) / count(*)), {P.DIGITS}) as rank from pw "
        f"left join r{TR.ITERATIONS} r on r.doc_id = pw.doc_id and r.word = pw.word group by pw.doc_id, phrase), "
        "best as materialized (select *, row_number() over (partition by doc_id order by rank desc, phrase) as place from ps "
        f"qualify place <= {P.PHRASES})")


def _ranked(spark, sf_dir):
    return P.phrase_ranked(read_table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")


@query("ranked_phrases", f"{_SQL} select doc_id, place, phrase, rank from best")
def q_ranked_phrases(spark, sf_dir):
    rows = _ranked(spark, sf_dir).select("doc_id", F.posexplode("phrases").alias("_p", "x"))
    return rows.select("doc_id", (F.col("_p") + 1).cast("bigint").alias("place"), F.col("x.phrase").alias("phrase"),
                       F.col("x.rank").alias("rank"))


@query("phrase_summary",
       f"{_SQL}, un as (select doc_id, phrase, rank / coalesce(nullif(sum(rank) over (partition by doc_id), 0), 1) as u from best), "
       "whole as (select doc_id, sum(u * u) as q from un group by doc_id), "
       "lacks as (select s.doc_id, s.pos, un.u from sents s join un on un.doc_id = s.doc_id "
       "where not exists (from ph where ph.doc_id = s.doc_id and ph.pos = s.pos and ph.phrase = un.phrase)), "
       f"di as (select s.doc_id, s.pos, round(sqrt(coalesce(sum(u * u), 0)), {P.DIGITS}) as distance from sents s "
       "left join lacks l on l.doc_id = s.doc_id and l.pos = s.pos group by s.doc_id, s.pos) "
       "select doc_id, row_number() over (partition by doc_id order by distance, pos) as place, pos, "
       f"distance from di qualify place <= {CANDIDATE_LIMIT}")
def q_phrase_summary(spark, sf_dir):
    return P.nearest_sentences(_ranked(spark, sf_dir), "doc_id")
