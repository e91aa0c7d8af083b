"""Text cleaning, segmentation and readability queries (whole texts)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuslens.functions import readability as rd
from corpuslens.functions import segment, text
from corpuslens.plans import sqlfrag as q
from corpuslens.plans.registry import query, r6
from corpuslens.sources.tables import read_table


def _docs(spark, sf_dir):
    return read_table(spark, sf_dir, "documents")


def _assistant_turns(spark, sf_dir):
    conv = read_table(spark, sf_dir, "conversations")
    return conv.where(F.col("role") == "assistant").select("conv_id", "turn", "text")


@query("preprocess_text",
       "with " + q.preprocess_ctes("documents", "doc_id", "text") + " select doc_id, cleaned from pp_f")
def q_preprocess_text(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", text.preprocess_text("text").alias("cleaned"))


@query("remove_brackets", f"select doc_id, {q.remove_brackets('text')} as no_brackets from documents")
def q_remove_brackets(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", text.remove_brackets("text").alias("no_brackets"))


@query("remove_cutoff", f"select doc_id, {q.remove_cutoff('text')} as cut from documents")
def q_remove_cutoff(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", text.remove_cutoff("text").alias("cut"))


@query("postprocess",
       f"select conv_id, turn, {q.remove_brackets(q.remove_cutoff('text'))} as post "
       f"from conversations where role = 'assistant'")
def q_postprocess(spark, sf_dir):
    return _assistant_turns(spark, sf_dir).select("conv_id", "turn", text.postprocess("text").alias("post"))


@query("strip_outputs",
       f"select conv_id, turn, {q.strip('text')} as stripped from conversations where role = 'assistant'")
def q_strip_outputs(spark, sf_dir):
    return _assistant_turns(spark, sf_dir).select("conv_id", "turn", text.strip("text").alias("stripped"))


@query("split_abstract",
       f"select doc_id, {q.abstract('text')} as abstract, {q.body('text')} as body from documents")
def q_split_abstract(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", text.abstract_of("text").alias("abstract"),
                                       text.body_of("text").alias("body"))


@query("split_sentences",
       f"select doc_id, cast(pos as bigint) as pos, s[pos] as sentence from "
       f"(select doc_id, s, unnest(range(1, len(s) + 1)) as pos from "
       f"(select doc_id, {q.sentences('text')} as s from documents))")
def q_split_sentences(spark, sf_dir):
    d = _docs(spark, sf_dir).select("doc_id", F.posexplode(segment.sentences("text")).alias("pos", "sentence"))
    return d.select("doc_id", (F.col("pos") + 1).cast("bigint").alias("pos"), "sentence")


@query("tokenize",
       f"select doc_id, cast(len(w) as bigint) as n_words, cast(len(list_distinct(w)) as bigint) as n_distinct_words, "
       f"cast(len({q.tokens('text')}) as bigint) as n_tokens from "
       f"(select doc_id, text, {q.words('text')} as w from documents)")
def q_tokenize(spark, sf_dir):
    d = _docs(spark, sf_dir).select("doc_id", "text", segment.words("text").alias("w"))
    return d.select("doc_id", F.size("w").cast("bigint").alias("n_words"),
                    F.size(F.array_distinct("w")).cast("bigint").alias("n_distinct_words"),
                    F.size(segment.tokens("text")).cast("bigint").alias("n_tokens"))


_SQL_READ = (
    f"select doc_id, w as n_words, s as n_sents, y as n_syll, l as n_letters, "
    f"{q.r6('case when w > 0 then 206.835 - 1.015 * (w / nullif(s, 0)) - 84.6 * (y / w) end')} as fre, "
    f"{q.r6('case when w > 0 then 0.39 * (w / nullif(s, 0)) + 11.8 * (y / w) - 15.59 end')} as fkgl, "
    f"{q.r6('case when w > 0 then 0.0588 * ((l / w) * 100.0) - 0.296 * ((s / w) * 100.0) - 15.8 end')} as cli "
    f"from (select doc_id, cast(len(ww) as bigint) as w, cast(len({q.sentences('text')}) as bigint) as s, "
    f"cast(greatest({q.vowel_groups('text')}, len(ww)) as bigint) as y, "
    f"cast(length(array_to_string(ww, '')) as bigint) as l "
    f"from (select doc_id, text, {q.words('text')} as ww from documents))"
)


@query("readability", _SQL_READ)
def q_readability(spark, sf_dir):
    d = rd.readability(_docs(spark, sf_dir).select("doc_id", "text"), "text")
    return d.select("doc_id", "n_words", "n_sents", "n_syll", "n_letters",
                    r6("fre").alias("fre"), r6("fkgl").alias("fkgl"), r6("cli").alias("cli"))
