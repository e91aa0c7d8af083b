r"""Chat formatting by prefix-target expansion (native Spark).

Every assistant turn becomes an example of its own: all turns before it are
the context, and only its text is trainable.  Turns behind the last
assistant turn make one more example without a trainable part, so that the
output holds every turn.

Template: ``### role: text</turn>`` per turn.  In roles and texts the
characters that could form a control string are escaped reversibly:
``\`` -> ``\b``, ``<`` -> ``\l``, ``#`` -> ``\h`` (and in roles ``:`` ->
``\c``).  So ``###`` and ``</turn>`` occur in the output as control strings
only, and splitting and unescaping are exact.

The loss mask is a half-open range of code points of ``formatted``.

Defined results: null text or role counts as empty; turns sort by (turn,
role, text), null turn first, so ties and repeated rows have one order; a
conversation with null conv_id is one conversation; a conversation without
assistant turn gives its context example only; an empty table gives no rows;
extra columns are ignored.  A conversation is the unit of work, as its
longest example holds all of it; examples are made one at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.common import query, table

HEAD, MID, END = "### ", ": ", "</turn>"


def escape(col, role: bool = False):
    out = F.replace(F.replace(F.replace(col, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l")),
                    F.lit("#"), F.lit("\\h"))
    return F.replace(out, F.lit(":"), F.lit("\\c")) if role else out


def unescape(col):
    for mark, char in (("\\c", ":"), ("\\h", "#"), ("\\l", "<"), ("\\b", "\\")):
        col = F.replace(col, F.lit(mark), F.lit(char))
    return col


def examples(conversations: DataFrame) -> DataFrame:
    """conv_id, target (index of the trained turn, -1: none), formatted,
    loss_start, loss_end (code points; equal: nothing is trained)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    convs = (conversations.select("conv_id", F.struct("turn", role.alias("role"), text.alias("text")).alias("t"))
             .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns")))
    last = F.size("turns") - 1
    targets = F.filter(F.sequence(F.lit(0), last), lambda i: F.get("turns", i)["role"] == "assistant")
    trailing = F.when(F.get("turns", last)["role"] != "assistant", F.array(last + 1)).otherwise(F.array().cast("array<int>"))
    one = (convs.select("conv_id", "turns", F.concat(targets, trailing).alias("at"))
           .select("conv_id", "turns", F.explode("at").alias("i")))
    context = F.array_join(F.transform(
        F.slice("turns", F.lit(1), F.col("i")),
        lambda t: F.concat(F.lit(HEAD), escape(t["role"], True), F.lit(MID), escape(t["text"]), F.lit(END))), "")
    trained = F.col("i") <= last
    opened = F.when(trained, F.concat("context", F.lit(HEAD + "assistant" + MID))).otherwise(F.col("context"))
    reply = F.when(trained, escape(F.get("turns", F.col("i"))["text"])).otherwise(F.lit(""))
    return (one.select("conv_id", "turns", "i", context.alias("context"))
            .select("conv_id", F.when(trained, F.col("i")).otherwise(-1).alias("target"),
                    opened.alias("opened"), reply.alias("reply"),
                    F.when(trained, F.lit(END)).otherwise(F.lit("")).alias("close"))
            .select("conv_id", "target", F.concat("opened", "reply", "close").alias("formatted"),
                    F.length("opened").cast("long").alias("loss_start"),
                    (F.length("opened") + F.length("reply")).cast("long").alias("loss_end")))


def read_turns(formatted):
    """Column: array of (role, text) that ``formatted`` was made from."""
    parts = F.split(formatted, F.lit("</turn>"), -1)
    parts = F.slice(parts, F.lit(1), F.size(parts) - 1)
    return F.transform(parts, lambda p: F.struct(
        unescape(F.substring(F.substring_index(p, MID, 1), F.lit(len(HEAD) + 1), F.length(p))).alias("role"),
        unescape(F.substring(p, F.length(F.substring_index(p, MID, 1)) + F.lit(len(MID) + 1), F.length(p)))
        .alias("text")))


def loss_text(formatted, start, end):
    return unescape(F.substring(formatted, (start + 1).cast("int"), (end - start).cast("int")))


def with_control_case(conversations: DataFrame) -> DataFrame:
    """The contract's conversation -7 joined to the table."""
    case = conversations.sparkSession.sql(
        r"""select cast(-7 as bigint) conv_id, cast(id as bigint) turn, if(id = 0, 'user', 'assistant') role,
            concat(char(92), '### Assistant: </turn> ok') text from range(2)""")
    return conversations.select("conv_id", "turn", "role", "text").unionByName(case)


OP8_SQL = r"""
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
t as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i,
         count(*) over (partition by conv_id) as n,
         length(text) + length(text) - length(replace(replace(replace(text, '\', ''), '<', ''), '#', ''))
           + 4 + 2 + 7 + length(role) + length(role)
           - length(replace(replace(replace(replace(role, '\', ''), '<', ''), '#', ''), ':', '')) as chars
  from c),
x as (
  select *, sum(chars) over (partition by conv_id order by i) as upto,
         (role = 'assistant')::int as a from t)
select conv_id, max(n)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by i)) as turns_sha256,
  coalesce(sum(length(text)) filter (a = 1), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by i) filter (a = 1), '')) as loss_sha256,
  (coalesce(sum(upto) filter (a = 1), 0) + coalesce(sum(upto) filter (i = n and a = 0), 0))::bigint as formatted_chars
from x group by conv_id"""


@query("op8_chat_format", OP8_SQL)
def op8_chat_format(spark, sf_dir):
    """Digests read back from the examples of every conversation."""
    out = examples(with_control_case(table(spark, sf_dir, "conversations")))
    # the example of the last turn holds every turn: the longest of its conversation
    order = F.when(F.col("target") < 0, F.lit(2 ** 31 - 1)).otherwise(F.col("target"))
    got = (out.withColumn("order", order)
           .groupBy("conv_id").agg(
               F.max_by(F.struct("formatted"), F.col("order")).alias("longest"),
               F.sort_array(F.collect_list(F.struct(
                   "order", loss_text(F.col("formatted"), F.col("loss_start"), F.col("loss_end")).alias("loss")))).alias("losses"),
               F.sum(F.length("formatted").cast("long")).alias("formatted_chars")))
    loss = F.array_join(F.transform("losses", lambda x: x["loss"]), "")
    return (got.select("conv_id", read_turns(F.col("longest.formatted")).alias("turns"), loss.alias("loss"),
                       "formatted_chars")
            .select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                    F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(
                        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
                    F.length("loss").cast("long").alias("loss_chars"),
                    F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars"))
