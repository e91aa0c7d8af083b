"""Learned sentence segmentation: the corpus' abbreviations and sentence
starters, and the sentences cut with them."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuslens.operators import sentence_model as M
from corpuslens.plans import sqlfrag as q
from corpuslens.plans.registry import query
from corpuslens.sources.tables import read_table


def _sql_core(x: str) -> str:
    opening, closing = M.OPENING.replace("'", "''"), M.CLOSING.replace("'", "''")
    return f"lower(regexp_replace(regexp_replace({x}, '{opening}', ''), '{closing}', ''))"


def _sql_rows() -> str:
    return (f"tk as (select doc_id, regexp_extract_all(coalesce(text, ''), '{M.TOKEN}') as t from documents), "
            "pr as (select doc_id, unnest(list_transform(t, lambda x, i: {'token': x, 'nxt': t[i + 1]}), recursive := true) from tk), "
            f"co as (select *, {_sql_core('token')} as core from pr where token <> chr(10)), "
            r"tr as materialized (select *, ends_with(core, '.') as dotted, regexp_replace(core, '\.$', '') as base from co)")


def _sql_log(n: str, p: str) -> str:
    return f"(case when {n} = 0 then 0.0 else {n} * ln({p}) end)"


def _sql_abbreviations() -> str:
    a = M.BEHIND_ABBREVIATION
    k, rest = "n_dotted", "n_plain"
    ratio = (f"2 * ({_sql_log(k, f'{a}::double')} + {_sql_log(rest, f'1 - {a}::double')} - {_sql_log(k, 'p')} - {_sql_log(rest, '1 - p')})")
    return (f"wc as (select base, sum(dotted::int)::bigint as n_dotted, sum((not dotted)::int)::bigint as n_plain from tr "
            f"where regexp_matches(base, '{q.plain(M.WORD)}') group by base), "
            "pp as (select least(sum(n_dotted) / sum(n_dotted + n_plain), 1 - 1e-9) as p from wc), "
            "wl as (select *, length(replace(base, '.', '')) as letters from wc, pp where n_dotted > 0), "
            f"ab as materialized (select base, n_dotted, n_plain, round({ratio} * exp(-letters) * (length(base) - letters + 1) "
            f"* pow(letters::double, -n_plain), {M.DIGITS}) as score from wl), "
            f"abb as materialized (select *, score >= {M.ABBREVIATION} as abbreviation from ab)")


def _sql_starters() -> str:
    def like(k, of, p):
        return f"({_sql_log(k, p)} + {_sql_log(f'({of} - {k})', f'(1 - {p})')})"
    ratio = (f"2 * ({like('s', 'b', '(s / b)')} + {like('(c - s)', '(n - b)', '((c - s) / (n - b))')} "
             f"- {like('s', 'b', '(c / n)')} - {like('(c - s)', '(n - b)', '(c / n)')})")
    return (f"sure as (select base, dotted, {_sql_core('nxt')} as word from tr where regexp_matches(token, '{M.EXCLAIMED}') "
            f"or (dotted and regexp_matches(base, '{q.plain(M.WORD)}'))), "
            "kept as materialized (select word from sure where not (dotted and base in (select base from abb where abbreviation))), "
            f"st as (select word, count(*)::double as s from kept where regexp_matches(word, '{q.plain(M.WORD)}') group by word), "
            f"al as (select base as word, count(*)::double as c from tr where regexp_matches(base, '{q.plain(M.WORD)}') group by base), "
            "nb as (select (select count(*) from kept)::double as b, greatest((select sum(c) from al), (select count(*) from kept) + 1)::double as n), "
            f"sc as (select word, s, c, b, n, round({ratio}, {M.DIGITS}) as score from st join al using (word), nb where c >= s), "
            f"sta as materialized (select *, score >= {M.STARTER} and s / b > c / n as starter from sc)")


@query("abbreviation_scores", f"with {_sql_rows()}, {_sql_abbreviations()} select * from abb")
def q_abbreviation_scores(spark, sf_dir):
    return M.abbreviation_scores(M.token_counts(read_table(spark, sf_dir, "documents"), "doc_id", "text"))


@query("sentence_starters", f"with {_sql_rows()}, {_sql_abbreviations()}, {_sql_starters()} "
       "select word, s::bigint as n_starts, c::bigint as n_all, score, starter from sta")
def q_sentence_starters(spark, sf_dir):
    counts = M.token_counts(read_table(spark, sf_dir, "documents"), "doc_id", "text")
    known = M.abbreviation_scores(counts).where("abbreviation").select("base")
    return M.starter_scores(counts, known).select("word", "n_starts", "n_all", "score", "starter")


def _sql_split() -> str:
    base = r"regexp_replace(core, '\.$', '')"
    upper = f"coalesce(regexp_matches(nxt, '{M.UPPER.replace(chr(39), chr(39) * 2)}'), false)"
    return (f"{_sql_rows()}, {_sql_abbreviations()}, {_sql_starters()}, "
            "px as (select doc_id, pos, t[pos] as token, t[pos + 1] as nxt from (select doc_id, t, unnest(range(1, len(t) + 1)) as pos from tk)), "
            f"pc as (select *, {_sql_core('token')} as core, {_sql_core('nxt')} as ncore, {upper} as up from px), "
            f"pb as (select *, {base} as base from pc), "
            f"ct as (select doc_id, pos, token, case when token = chr(10) then false when regexp_matches(token, '{M.EXCLAIMED}') "
            f"or regexp_matches(core, '{M.EXCLAIMED}') then true when not ends_with(core, '.') then false "
            f"when regexp_matches(base, '{M.NUMBER}') then up "
            r"when base in (select base from abb where abbreviation) or regexp_matches(base, '^\p{L}$') "
            "then up and coalesce(ncore in (select word from sta where starter), false) else true end as cut from pb), "
            "jn as (select doc_id, string_agg(case when token = chr(10) then token when cut then token || chr(10) else token || ' ' end, '' "
            "order by pos) as t from ct group by doc_id), "
            "sp as (select doc_id, list_filter(list_transform(string_split(t, chr(10)), lambda s: trim(s)), lambda s: s <> '') as l from jn)")


@query("split_sentences_learned",
       f"with {_sql_split()} select doc_id, unnest(range(1, len(l) + 1)) as pos, unnest(l) as sentence from sp")
def q_split_sentences_learned(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    known, starters = M.learned_lists(docs, "doc_id", "text")
    cut = M.split_learned(docs, "doc_id", "text", known, starters)
    rows = cut.select("doc_id", F.posexplode("sentences").alias("_p", "sentence"))
    return rows.select("doc_id", (F.col("_p") + 1).cast("bigint").alias("pos"), "sentence")
