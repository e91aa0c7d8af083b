"""Prompt construction as column expressions: chat messages, a rendered chat
prompt with an open final turn, and instruction prompts (training and
inference form).  Text is concatenated with ``concat`` (never a format
string), so a ``%`` or ``{}`` inside an article is inert."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Prompt texts that must equal the original job's prompts.
# ---------------------------------------------------------------------------
SYSTEM_PROMPT_BASE = (
    "You are a specialist medical communicator responsible for translating biomedical articles into a "
    "clear, accurate 10-20 sentence summary for non-experts. The summary should be at a Flesch–Kincaid "
    "grade level of 10–14 and explain any technical terms."
)
SYSTEM_PROMPT_COT = (
    "\nYou are a specialist medical communicator responsible for translating biomedical articles into clear, "
    "accurate summaries for non-experts.\n\n"
    "Your task is to generate a LAY summary in 10–20 sentences at a Flesch–Kincaid grade level of 10–14. "
    "You must ensure the summary is factually accurate, easy to understand, and explains any technical terms "
    "used.\n\n"
    "Follow these three steps:\n\n"
    "Step 1: Based on the provided extracted summary of the article as input, write an initial LAY summary "
    "that is clear, concise, and accessible to a general audience.\n\n"
    "Step 2: Compare your initial summary with the extracted summary. Reflect on whether all key claims are "
    "supported by the original text. Note any inconsistencies, hallucinations, or missing information.\n\n"
    "Step 3: Revise your summary as needed to improve factual accuracy and clarity. Output the corrected final "
    "version enclosed within <R> and </R> tags.\n"
)
SYSTEM_PROMPT_FACTUALITY = (
    "You are a specialist medical communicator responsible for translating biomedical articles into a clear, "
    "accurate 10 to 20 sentence summary for non‑experts. The summary should have a Flesch–Kincaid grade level "
    "of 10 to 14, explaining any technical terms in simple language. Ensure factual accuracy by using "
    "terminology from the source article, and omit all in‑text citations."
)
SYSTEM_PROMPTS = {"base": SYSTEM_PROMPT_BASE, "cot": SYSTEM_PROMPT_COT, "factuality": SYSTEM_PROMPT_FACTUALITY}
ASSISTANT_PREFIX = "Lay Summary:"
INSTRUCTION = SYSTEM_PROMPT_BASE
INSTRUCTION_TEMPLATE = (
    "Below is an instruction that describes a task, paired with an input that provides further context. "
    "Write a response that appropriately completes the request.\n\n"
    "### Instruction:\n{}\n\n### Input:\n{}\n\n### Response:\n{}"
)
DEFAULT_EOS = "<|end_of_text|>"

# Rendering markers of the default chat template (a parameter of render_chat).
ROLE_OPEN, ROLE_CLOSE, TURN_END = "<|", "|>\n", "<|end|>\n"


def system_prompt(version: str) -> str:
    if version not in SYSTEM_PROMPTS:
        raise NotImplementedError(f"unknown prompt version {version!r}")
    return SYSTEM_PROMPTS[version]


def chat_messages(article, version: str = "base") -> Column:
    """array<struct<role, content>>: system prompt, the article, the open answer."""
    a = F.col(article) if isinstance(article, str) else article
    msg = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return F.array(msg("system", F.lit(system_prompt(version))), msg("user", a),
                   msg("assistant", F.lit(ASSISTANT_PREFIX)))


def render_chat(messages, open_last: bool = True, role_open: str = ROLE_OPEN,
                role_close: str = ROLE_CLOSE, turn_end: str = TURN_END) -> Column:
    """Render messages to one prompt; the final turn stays open (no end marker)."""
    m = F.col(messages) if isinstance(messages, str) else messages
    n = F.size(m)

    def one(x, i):
        end = F.when((i < n - 1) | F.lit(not open_last), F.lit(turn_end)).otherwise(F.lit(""))
        return F.concat(F.lit(role_open), x.getField("role"), F.lit(role_close),
                        F.coalesce(x.getField("content"), F.lit("")), end)

    return F.array_join(F.transform(m, one), "")


def instruction_prompt(input_col, output_col=None, eos: str | None = DEFAULT_EOS,
                       instruction: str = INSTRUCTION) -> Column:
    """Template filled with (instruction, input, output); training form adds EOS.

    With ``output_col=None`` this is the inference form: empty response, no EOS.
    """
    p0, p1, p2, p3 = INSTRUCTION_TEMPLATE.split("{}")
    inp = F.coalesce(F.col(input_col) if isinstance(input_col, str) else input_col, F.lit(""))
    if output_col is None:
        return F.concat(F.lit(p0 + instruction + p1), inp, F.lit(p2 + p3))
    out = F.coalesce(F.col(output_col) if isinstance(output_col, str) else output_col, F.lit(""))
    return F.concat(F.lit(p0 + instruction + p1), inp, F.lit(p2), out, F.lit(p3 + (eos or "")))


def run_name(source, train_file, model_id, with_dev=None) -> Column:
    """``finetuned_<source>[_<train file w/o extension>]_<model>[_with_dev]``.

    ``/``, ``\\`` and ``-`` become ``_``.  A null ``train_file`` leaves its part
    out; ``with_dev`` (a boolean column) adds the ending.
    """
    def plain(c):
        return F.translate(c, "/\\-", "___")
    train = F.concat(F.lit("_"), F.regexp_replace(plain(train_file), r"\.[^.]*$", ""))
    model = F.replace(F.lower(F.substring_index(model_id, "/", -1)), F.lit("-"), F.lit("_"))
    ending = F.lit("") if with_dev is None else F.when(with_dev, F.lit("_with_dev")).otherwise(F.lit(""))
    return F.concat(F.lit("finetuned_"), plain(source), F.coalesce(train, F.lit("")), F.lit("_"), model, ending)
