"""Extractive-summary queries: vectors, cosine, TextRank, ranking, top-n
summaries (wide, long, partitioned sink) and the non-extractive variants."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuslens.functions import text
from corpuslens.operators import extract, textrank
from corpuslens.options import CANDIDATE_LIMIT, SUMMARY_LENGTHS, Variant, variant_name_col
from corpuslens.plans import sqlfrag as q
from corpuslens.plans.registry import query, r6
from corpuslens.session import scratch_dir
from corpuslens.sources import publish, sinks
from corpuslens.sources.tables import corpus, read_table

TR = textrank
_TELEPORT = repr(1.0 - TR.DAMPING)
_DAMP = repr(TR.DAMPING)


# --------------------------------------------------------------------------
# SQL oracle builders
# --------------------------------------------------------------------------
def _sql_input(opts: Variant) -> str:
    """CTE ``rin(doc_id, text)``: the ranking input of every document."""
    src = q.body("text") if opts.part == "body" else "text"
    if opts.cleaned:
        return ("src0 as (select doc_id, " + src + " as t0 from documents), "
                + q.preprocess_ctes("src0", "doc_id", "t0", "text") + ", rin as (select doc_id, text from pp_f)")
    return f"rin as (select doc_id, {src} as text from documents)"


_TRW = r"'\p{L}{3,}'"


def _sql_sents() -> str:
    blank = f"coalesce({q.strip('text')}, '') = ''"
    return (f"sl as (select doc_id, case when {blank} then []::varchar[] else {q.sentences('text')} end as s from rin), "
            "sents as (select doc_id, pos, s[pos] as sentence from "
            "(select doc_id, s, unnest(range(1, len(s) + 1)) as pos from sl))")


def _sql_edges(docs: str) -> str:
    """CTE ``e(doc_id, a, b, weight)`` for the documents in ``docs``(doc_id, text)."""
    look = TR.LOOKBACK
    return (
        f"tw as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as i from "
        f"(select doc_id, regexp_extract_all(lower(coalesce(text, '')), {_TRW}) as w from {docs})), "
        "fw as (select doc_id, word, row_number() over (partition by doc_id order by i) as j "
        "from tw), "
        f"pr as (select x.doc_id, x.word as a, y.word as b from fw x join fw y on x.doc_id = y.doc_id "
        f"and y.j > x.j and y.j <= x.j + {look} where x.word <> y.word), "
        "e as (select doc_id, a, b, count(*) as weight from "
        "(select doc_id, a, b from pr union all select doc_id, b as a, a as b from pr) group by doc_id, a, b)"
    )


def _sql_pagerank() -> str:
    """CTEs ow, tr, nn, r0..r10 over ``e``; the last is ``r{ITERATIONS}(doc_id, word, r)``."""
    parts = ["ow as (select doc_id, a, sum(weight) as out_w from e group by doc_id, a)",
             "tr as (select e.doc_id, e.a, e.b, e.weight / ow.out_w as p from e join ow using (doc_id, a))",
             "nn as (select doc_id, cast(count(*) as double) as n from ow group by doc_id)",
             "r0 as (select ow.doc_id, ow.a as word, 1.0 / nn.n as r from ow join nn using (doc_id))"]
    for i in range(1, TR.ITERATIONS + 1):
        parts.append(
            f"r{i} as (select c.doc_id, c.b as word, cast({_TELEPORT} as double) / nn.n "
            f"+ cast({_DAMP} as double) * c.s as r from (select tr.doc_id, tr.b, sum(tr.p * r{i - 1}.r) as s "
            f"from tr join r{i - 1} on r{i - 1}.doc_id = tr.doc_id and r{i - 1}.word = tr.a "
            f"group by tr.doc_id, tr.b) c join nn using (doc_id))")
    return ", ".join(parts)


def _sql_candidates() -> str:
    lim = CANDIDATE_LIMIT
    return (
        f"nsent as (select doc_id, count(*) as n from sents group by doc_id), "
        f"longd as (select rin.doc_id, rin.text from rin join nsent using (doc_id) where nsent.n > {lim}), "
        + _sql_edges("longd") + ", " + _sql_pagerank() + ", "
        f"lsents as (select * from sents where doc_id in (select doc_id from longd)), "
        f"ssw as (select distinct doc_id, pos, unnest(regexp_extract_all(lower(coalesce(sentence, '')), {_TRW})) "
        f"as word from lsents), "
        f"sscore as (select ssw.doc_id, ssw.pos, coalesce(sum(rr.r), 0.0) as score from ssw "
        f"left join r{TR.ITERATIONS} rr on rr.doc_id = ssw.doc_id and rr.word = ssw.word "
        f"group by ssw.doc_id, ssw.pos), "
        f"lrank as (select l.doc_id, l.pos, l.sentence, row_number() over (partition by l.doc_id "
        f"order by round(coalesce(sc.score, 0.0), {TR.SCORE_DIGITS}) desc, l.pos) as rk "
        f"from lsents l left join sscore sc using (doc_id, pos)), "
        f"cands as (select doc_id, pos, sentence from sents where doc_id not in (select doc_id from longd) "
        f"union all select doc_id, pos, sentence from lrank where rk <= {lim})"
    )


def _sql_tfidf() -> str:
    return (
        f"st as (select doc_id, pos, term, count(*) as tf from "
        f"(select doc_id, pos, unnest({q.words('sentence')}) as term from sents) group by doc_id, pos, term), "
        "dt as (select doc_id, term, sum(tf) as tf from st group by doc_id, term), "
        "nd as (select count(*) as n from rin), "
        "idf as (select term, ln((1.0 + nd.n) / (1.0 + count(*))) + 1.0 as idf from dt, nd group by term, nd.n), "
        "dw as (select dt.doc_id, dt.term, dt.tf, dt.tf * idf.idf as w, idf.idf from dt join idf using (term)), "
        "dn as (select doc_id, sqrt(sum(w * w)) as dnorm from dw group by doc_id)"
    )


def _sql_cosine(cands: str) -> str:
    return (
        f"sw as (select st.doc_id, st.pos, st.tf * dw.idf as ws, dw.w as wd from st "
        f"join (select doc_id, pos from {cands}) cp using (doc_id, pos) join dw using (doc_id, term)), "
        f"sn as (select st.doc_id, st.pos, sqrt(sum((st.tf * dw.idf) * (st.tf * dw.idf))) as snorm from st "
        f"join (select doc_id, pos from {cands}) cp using (doc_id, pos) join dw using (doc_id, term) "
        f"group by st.doc_id, st.pos), "
        "sd as (select doc_id, pos, sum(ws * wd) as dot from sw group by doc_id, pos), "
        "cosv as (select sn.doc_id, sn.pos, case when sn.snorm > 0 and dn.dnorm > 0 then "
        "coalesce(sd.dot, 0.0) / (sn.snorm * dn.dnorm) end as cosine from sn "
        "left join sd using (doc_id, pos) left join dn using (doc_id))"
    )


def sql_ranked(opts: Variant, use_textrank: bool = True) -> str:
    """``with ...`` ending in ``ranked(doc_id, rk, pos, sentence, cosine)``."""
    cands = "cands"
    body = [_sql_input(opts), _sql_sents()]
    if use_textrank:
        body.append(_sql_candidates())
    else:
        cands = "sents"
    body += [_sql_tfidf(), _sql_cosine(cands),
             f"ranked as (select c.doc_id, row_number() over (partition by c.doc_id order by "
             f"round(cosv.cosine, {extract.COSINE_DIGITS}) desc nulls last, c.sentence desc, c.pos) as rk, "
             f"c.pos, c.sentence, cosv.cosine from {cands} c left join cosv using (doc_id, pos))"]
    return "with " + ", ".join(body)


def sql_summaries(opts: Variant, lengths=SUMMARY_LENGTHS) -> str:
    """``... , wide(doc_id, article, summary, extracted_summary_<n>...)``."""
    cols = []
    for n in lengths:
        s = (f"coalesce(string_agg(case when r.rk <= {n} then r.sentence end, chr(10) order by r.rk), '')")
        if opts.abstract_first:
            s = q.strip(f"{q.abstract('d.text')} || chr(10) || {s}")
        cols.append(f"{s} as extracted_summary_{n}")
    return (sql_ranked(opts) + ", wide as materialized (select d.doc_id, d.source, d.text as article, "
            f"{q.abstract('d.text')} as summary, " + ", ".join(cols)
            + " from documents d left join ranked r on r.doc_id = d.doc_id group by d.doc_id, d.source, d.text)")


def _sql_long(lengths=SUMMARY_LENGTHS) -> str:
    return " union all ".join(f"select doc_id, article, summary, {n} as n_sentences, extracted_summary_{n} as transformed from wide"
                              for n in lengths)


# --------------------------------------------------------------------------
# Spark builders
# --------------------------------------------------------------------------
def _wide(spark, sf_dir, opts: Variant):
    return extract.extract_wide(corpus(spark, sf_dir), opts)


EXTRACT = Variant(ranked=True)


# words don't cross sentences, so a document's counts need no sentences
@query("tfidf_vectors",
       f"with dt as (select doc_id, term, count(*) as tf from (select doc_id, unnest({q.words('text')}) as term "
       "from documents) group by all), idf as (select term, ln((1.0 + (select count(*) from documents)) / (1.0 + count(*))) "
       f"+ 1.0 as idf from dt group by term) select doc_id, term, tf, {q.r6('tf * idf')} as w from dt join idf using (term)")
def q_tfidf_vectors(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    doc_terms = extract.document_terms(docs, "doc_id", "text")
    return doc_terms.select("doc_id", "term", F.col("tf").cast("bigint").alias("tf"), r6("w").alias("w"))


@query("sentence_cosine",
       "with " + _sql_input(Variant()) + ", " + _sql_sents() + ", " + _sql_tfidf() + ", "
       + _sql_cosine("sents") + f" select s.doc_id, s.pos, {q.r6('cosv.cosine')} as cosine "
       "from sents s left join cosv using (doc_id, pos)")
def q_sentence_cosine(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = extract.scored_documents(docs, "doc_id", "text", None)
    rows = scored.select("doc_id", F.posexplode("cos").alias("_p", "cosine"))
    return rows.select("doc_id", (F.col("_p") + 1).cast("bigint").alias("pos"), r6("cosine").alias("cosine"))


_SQL_ALLDOCS_EDGES = "with rin as (select doc_id, text from documents), " + _sql_edges("rin")


@query("cooccurrence_edges", _SQL_ALLDOCS_EDGES + " select doc_id, a, b, cast(weight as bigint) as weight from e")
def q_cooccurrence_edges(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return TR.cooccurrence_edges(docs, "doc_id", "text")


_SQL_PAGERANK = (_SQL_ALLDOCS_EDGES + ", " + _sql_pagerank()
                 + f" select doc_id, word, {q.r6('r')} as rank from r{TR.ITERATIONS}")


@query("word_pagerank", _SQL_PAGERANK)
def q_word_pagerank(spark, sf_dir):
    """PageRank of an edge table."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    ranks = TR.word_pagerank(TR.cooccurrence_edges(docs, "doc_id", "text"), "doc_id")
    return ranks.select("doc_id", "word", r6("rank").alias("rank"))


@query("doc_word_ranks", _SQL_PAGERANK)
def q_doc_word_ranks(spark, sf_dir):
    """The same ranks, each document's graph in its own row."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return TR.doc_word_ranks(docs, "doc_id", "text").select("doc_id", "word", r6("rank").alias("rank"))


@query("textrank_top80", sql_ranked(Variant()) + " select doc_id, cast(pos as bigint) as pos from cands")
def q_textrank_top80(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = extract.scored_documents(docs, "doc_id", "text", CANDIDATE_LIMIT)
    every = F.transform("sents", lambda s, i: i + 1)
    return scored.select("doc_id", F.explode(F.coalesce("keep", every).cast("array<bigint>")).alias("pos"))


@query("extract_ranked", sql_ranked(Variant())
       + f" select doc_id, cast(rk as bigint) as rank, cast(pos as bigint) as pos, sentence, "
       f"{q.r6('cosine')} as cosine from ranked")
def q_extract_ranked(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    ranked = extract.ranked_sentences(docs, "doc_id", "text")
    return ranked.select("doc_id", F.col("rank").cast("bigint").alias("rank"),
                         F.col("pos").cast("bigint").alias("pos"), "sentence", r6("cosine").alias("cosine"))


def _top_query(n: int):
    @query(f"extract_top{n}", sql_summaries(EXTRACT) + f" select doc_id, extracted_summary_{n} as transformed from wide")
    def q_top(spark, sf_dir):
        return _wide(spark, sf_dir, EXTRACT).select("doc_id", F.col(f"extracted_summary_{n}").alias("transformed"))
    return q_top


for _n in SUMMARY_LENGTHS:
    _top_query(_n)


@query("extract_wide", sql_summaries(EXTRACT) + " select * exclude (source) from wide")
def q_extract_wide(spark, sf_dir):
    return _wide(spark, sf_dir, EXTRACT)


@query("extract_fanout", sql_summaries(EXTRACT) + " " + _sql_long())
def q_extract_fanout(spark, sf_dir):
    """One write for all lengths, partitioned by length; read back."""
    long = extract.extract_long(_wide(spark, sf_dir, EXTRACT))
    path = scratch_dir(spark, "extract-fanout")
    texts = ["article", "summary", "transformed"]
    sinks.write_variants(long, path, texts, "n_sentences")
    back = sinks.read_variants(spark, path, texts)
    return back.select("doc_id", "article", "summary", F.col("n_sentences").cast("int").alias("n_sentences"), "transformed")


_CONCAT = Variant(ranked=True, abstract_first=True)
_EXCLUDE = Variant("body", ranked=True)
_CLEANED = Variant("body", ranked=True, cleaned=True)


@query("extract_concat_abstract", sql_summaries(_CONCAT) + " " + _sql_long())
def q_extract_concat_abstract(spark, sf_dir):
    return extract.extract_long(_wide(spark, sf_dir, _CONCAT))


@query("extract_exclude_abstract", sql_summaries(_EXCLUDE) + " " + _sql_long())
def q_extract_exclude_abstract(spark, sf_dir):
    return extract.extract_long(_wide(spark, sf_dir, _EXCLUDE))


@query("extract_preprocessed", sql_summaries(_CLEANED) + " " + _sql_long())
def q_extract_preprocessed(spark, sf_dir):
    """Cleaned bodies, ranked: clean-up and extraction in one variant."""
    return extract.extract_long(_wide(spark, sf_dir, _CLEANED))


@query("extract_blank_guard", sql_ranked(_EXCLUDE)
       + f", nr as (select doc_id, count(*) as n from ranked group by doc_id) "
       f"select rin.doc_id, coalesce({q.strip('rin.text')}, '') = '' as is_blank, "
       f"cast(coalesce(nr.n, 0) as bigint) as n_ranked from rin left join nr using (doc_id)")
def q_extract_blank_guard(spark, sf_dir):
    c = corpus(spark, sf_dir)
    inp = c.select("doc_id", extract.ranking_input("article", _EXCLUDE).alias("_input"))
    ranked = extract.ranked_documents(inp, "doc_id", "_input", _EXCLUDE.candidate_limit, carry=["_input"])
    return ranked.select("doc_id", text.is_blank("_input").alias("is_blank"),
                         F.size("ranked").cast("bigint").alias("n_ranked"))


def _variant_sql(transformed: str, pre: str = "") -> str:
    return (pre + f"select d.doc_id, d.text as article, {q.abstract('d.text')} as summary, {transformed} "
            f"as transformed from documents d")


@query("variant_abstract_only", _variant_sql(q.abstract("d.text")))
def q_variant_abstract_only(spark, sf_dir):
    return extract.transform(corpus(spark, sf_dir), Variant("abstract"))


@query("variant_fulltext", _variant_sql("d.text"))
def q_variant_fulltext(spark, sf_dir):
    return extract.transform(corpus(spark, sf_dir), Variant())


@query("variant_preprocessed", "with " + q.preprocess_ctes("documents", "doc_id", "text")
       + " " + _variant_sql("pp.cleaned").replace("from documents d", "from documents d join pp_f pp using (doc_id)"))
def q_variant_preprocessed(spark, sf_dir):
    return extract.transform(corpus(spark, sf_dir), Variant(cleaned=True))


@query("variant_cache", "select doc_id, 'article' as variant, text as transformed from documents union all "
       f"select doc_id, 'abstract' as variant, {q.abstract('text')} as transformed from documents")
def q_variant_cache(spark, sf_dir):
    """K3: both variants are published together; the second call finds them
    by the content of the corpus."""
    root = scratch_dir(spark, "variants")
    docs = corpus(spark, sf_dir)
    names, source = ["article", "abstract"], docs.select("doc_id", "article")

    def build():
        return {p: extract.transform(docs, Variant(p)).select("doc_id", "transformed") for p in names}

    publish.load_or_build(spark, root, names, build, source, {"parts": names})
    cached = publish.load_or_build(spark, root, names, dict, source, {"parts": names})
    tagged = [df.select("doc_id", F.lit(name).alias("variant"), "transformed") for name, df in cached.items()]
    return tagged[0].unionByName(tagged[1])


# -- variant naming ------------------------------------------------------------
_VARIANTS = [
    Variant(), Variant(cleaned=True), Variant("abstract"), Variant("abstract", cleaned=True),
    Variant(ranked=True), Variant("body", ranked=True), Variant(ranked=True, abstract_first=True),
    Variant(ranked=True, cleaned=True),
]


def _variant_names_sql() -> str:
    names = []
    for o in _VARIANTS:
        for n in (SUMMARY_LENGTHS if o.ranked else (None,)):
            parts = "".join(f" || '_{p}'" for p in o.suffixes(n))
            names.append(f"select dataset, split, dataset || '_' || split{parts} as variant from ds")
    return (f"with ds as (select distinct lang as dataset, (case doc_id % 10 when 8 then 'validation' "
            f"when 9 then 'test' else 'train' end) as split from documents) " + " union all ".join(names))


@query("variant_name", _variant_names_sql())
def q_variant_name(spark, sf_dir):
    ds = corpus(spark, sf_dir).select("dataset", "split").distinct()
    names = [variant_name_col(F.col("dataset"), F.col("split"), o, n)
             for o in _VARIANTS for n in (SUMMARY_LENGTHS if o.ranked else (None,))]
    return ds.select("dataset", "split", F.explode(F.array(*names)).alias("variant"))
