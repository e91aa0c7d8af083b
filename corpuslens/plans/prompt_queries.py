"""Prompt queries over the corpus: chat messages, rendered chat prompts,
instruction prompts (training and inference), run names."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuslens.functions import prompts, text
from corpuslens.plans import sqlfrag as q
from corpuslens.plans.registry import query
from corpuslens.sources.tables import read_table

PROMPT_VERSION = "base"
RUN_MODEL_ID = "meta-org/Example-Model-8B-Instruct"


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_SYS = _lit(prompts.system_prompt(PROMPT_VERSION))
_ASSIST = _lit(prompts.ASSISTANT_PREFIX)


@query("chat_messages",
       f"select doc_id, 0 as turn, 'system' as role, {_SYS} as content from documents union all "
       f"select doc_id, 1 as turn, 'user' as role, text as content from documents union all "
       f"select doc_id, 2 as turn, 'assistant' as role, {_ASSIST} as content from documents")
def q_chat_messages(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    msgs = docs.select("doc_id", F.posexplode(prompts.chat_messages("text", PROMPT_VERSION)).alias("turn", "m"))
    return msgs.select("doc_id", "turn", F.col("m.role").alias("role"), F.col("m.content").alias("content"))


@query("chat_render",
       f"select doc_id, '<|system|>' || chr(10) || {_SYS} || '<|end|>' || chr(10) || '<|user|>' || chr(10) "
       f"|| coalesce(text, '') || '<|end|>' || chr(10) || '<|assistant|>' || chr(10) || {_ASSIST} as prompt "
       f"from documents")
def q_chat_render(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.select("doc_id", prompts.render_chat(prompts.chat_messages("text", PROMPT_VERSION)).alias("prompt"))


def _version_query(version: str):
    system = _lit(prompts.system_prompt(version))

    @query(f"chat_messages_{version}",
           f"select doc_id, [{system}, text, {_ASSIST}] as contents from documents")
    def q_version(spark, sf_dir):
        docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
        return docs.select("doc_id", F.transform(prompts.chat_messages("text", version), lambda m: m["content"])
                           .alias("contents"))
    return q_version


for _version in ("cot", "factuality"):
    _version_query(_version)


_P0, _P1, _P2, _P3 = prompts.INSTRUCTION_TEMPLATE.split("{}")


def _sql_instruction(train: bool) -> str:
    head = _lit(_P0 + prompts.INSTRUCTION + _P1)
    inp = f"coalesce({q.body('text')}, '')"
    if train:
        tail = f" || {_lit(_P2)} || coalesce({q.abstract('text')}, '') || {_lit(_P3 + prompts.DEFAULT_EOS)}"
    else:
        tail = f" || {_lit(_P2 + _P3)}"
    return f"select doc_id, {head} || {inp}{tail} as text from documents"


@query("instruction_prompt_train", _sql_instruction(True))
def q_instruction_prompt_train(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.select("doc_id", prompts.instruction_prompt(text.body_of("text"), text.abstract_of("text"))
                       .alias("text"))


@query("instruction_prompt_infer", _sql_instruction(False))
def q_instruction_prompt_infer(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.select("doc_id", prompts.instruction_prompt(text.body_of("text"), None).alias("text"))


def _sql_fmt(x: str) -> str:
    return f"translate({x}, '/\\-', '___')"


@query("run_name",
       f"select page_id, 'finetuned_' || {_sql_fmt('url')} || case when page_id % 3 = 0 then '' else '_' || "
       rf"regexp_replace({_sql_fmt('url')}, '\.[^.]*$', '') end || '_' || "
       f"replace(lower(split_part({_lit(RUN_MODEL_ID)}, '/', -1)), '-', '_') || "
       "case when page_id % 2 = 0 then '_with_dev' else '' end as run_name from pages")
def q_run_name(spark, sf_dir):
    """Every third run has no train file, every other one the development data."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    train = F.when(F.col("page_id") % 3 != 0, F.col("url"))
    return pages.select("page_id", prompts.run_name(F.col("url"), train, F.lit(RUN_MODEL_ID), F.col("page_id") % 2 == 0)
                        .alias("run_name"))
