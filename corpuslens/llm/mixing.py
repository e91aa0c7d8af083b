"""Mixing sources to target weights by capped water-filling (native Spark).

Every source has a weight; the mix shall hold ``budget`` words in all (by
default as many as there are).  A source whose share would exceed
``max_epochs`` times its own size is clamped there, and what it leaves over
goes to the others by weight, until no source is above its cap.  A source's
target divided by its size is its number of repetitions: every document is
taken the whole part often, and a seeded selection of documents once more,
chosen so that the source's taken words come as near to its target as whole
documents allow.

The selection takes the documents in the order of md5(seed, doc_id) up to a
cut.  The cut is found in two steps, neither of which gathers a source: sums
per (source, first hex digits of the md5), then a window over the one bucket
that the target falls into.  Equal doc_ids share a hash and are taken alike.

Defined results: a null or empty text has size 0 and is taken 0 words; a
null source is a source of its own, last in order; sources without any word
get target 0; null weights don't occur (weights go by rank); an empty table
gives an empty result; extra columns are passed through by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.llm.common import BROADCAST_BYTES, WORD_PATTERN, boxed, empty_if_null, query, saved, table, unboxed

#: fixed values of the contract: weights by the sources' code point order
WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3.0
SEED = "mix"
#: hex digits of the md5 that make a bucket; a source spreads over 16^3 windows
BUCKET_DIGITS = 3
#: shares of a source where the plan is too large to be sent to every task
SALTS = 64


def word_count(name: str = "text"):
    return F.regexp_count(empty_if_null(name), F.lit(WORD_PATTERN)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: float = MAX_EPOCHS,
                   budget: float | None = None) -> DataFrame:
    """``sizes(source, source_size)``, one row per source -> the same with
    weight and target.  Only scalars of each round reach the driver."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                        (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    s = saved(sizes.select("source", F.col("source_size").cast("double").alias("size"),
                           pick.alias("weight")))
    s = s.withColumn("cap", F.col("size") * max_epochs)
    total = s.agg(F.sum("size")).first()[0] or 0.0
    total = total if budget is None else min(float(budget), total * max_epochs)
    level, clamped = 0.0, -1
    while total > 0:
        over = F.lit(level) * F.col("weight") >= F.col("cap") if clamped >= 0 else F.col("cap") <= 0
        r = s.agg(F.sum(F.when(over, F.col("cap")).otherwise(0.0)).alias("c"),
                  F.sum(F.when(over, 0.0).otherwise(F.col("weight"))).alias("w"),
                  F.sum(over.cast("long")).alias("n")).first()
        if r["n"] == clamped or r["w"] == 0:
            break
        level, clamped = max(total - r["c"], 0.0) / r["w"], r["n"]
    return s.select("source", F.col("size").cast("long").alias("source_size"), "weight",
                    F.least(F.col("cap"), F.lit(level) * F.col("weight")).alias("target"))


def _with_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` with the plan of their source: one plan row per source, sent
    to every task if its counted size allows, so that no text is shuffled;
    else joined on (source, salt), so that no source is one task."""
    same = F.col("source").eqNullSafe(F.col("t_source"))
    count, longest = plan.agg(F.count("*"), F.max(F.octet_length("t_source"))).first()
    if count * (96 + (longest or 0)) <= BROADCAST_BYTES:
        return rows.join(F.broadcast(plan), same)
    salted = plan.withColumn("_p_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("_salt", F.pmod(F.xxhash64("_hash"), F.lit(SALTS)).cast("int")).join(
        salted, same & (F.col("_salt") == F.col("_p_salt")))


def planned(docs: DataFrame, weights=WEIGHTS, max_epochs: float = MAX_EPOCHS, seed: str = SEED,
            budget: float | None = None) -> DataFrame:
    """The boxed rows of ``docs`` with size, source_size, target, repeats."""
    hashed = boxed(docs).withColumns({
        "source": F.col("_row.source"), "_size": word_count("_row.text"),
        "_hash": F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_row.doc_id").cast("string"), F.lit("")))),
    })
    narrow = saved(hashed.select("source", "_size", "_hash"))
    bucket = F.substring("_hash", 1, BUCKET_DIGITS).alias("_bucket")
    buckets = saved(narrow.groupBy("source", bucket).agg(F.sum("_size").alias("b_size")))
    targets = saved(source_targets(buckets.groupBy("source").agg(F.sum("b_size").alias("source_size")),
                                   weights, max_epochs, budget))
    want = targets.select(
        F.col("source").alias("t_source"), "source_size", "target",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
        .otherwise(0).cast("long").alias("whole"))
    # words that the partial repetition shall add
    want = saved(want.withColumn("part", F.col("target") - F.col("whole") * F.col("source_size")))
    # sums below each bucket: at most 16^digits rows per source
    upto = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    edge = (buckets.withColumn("b_end", F.sum("b_size").over(upto))
            .join(want, F.col("source").eqNullSafe(F.col("t_source")))
            .filter((F.col("part") > 0) & (F.col("b_end") - F.col("b_size") < F.col("part"))
                    & (F.col("b_end") >= F.col("part")))
            .select("t_source", "part", F.col("_bucket").alias("e_bucket"),
                    (F.col("b_end") - F.col("b_size")).alias("below")))
    edge = saved(edge)
    inside = (narrow.join(edge, F.col("source").eqNullSafe(F.col("t_source"))
                          & (bucket == F.col("e_bucket")))
              .groupBy("t_source", "part", "below", "_hash").agg(F.sum("_size").alias("h_size")))
    ordered = Window.partitionBy("t_source").orderBy("_hash").rowsBetween(Window.unboundedPreceding, 0)
    inside = (inside.withColumn("end", F.col("below") + F.sum("h_size").over(ordered))
              .withColumn("start", F.col("end") - F.col("h_size")))
    # the document that holds the target is taken if that ends nearer to it
    cut = (inside.filter((F.col("start") < F.col("part")))
           .filter((F.col("end") < F.col("part"))
                   | (F.col("end") - F.col("part") <= F.col("part") - F.col("start")))
           .groupBy("t_source").agg(F.max("_hash").alias("cut")))
    plan = saved(want.join(
        edge.select(F.col("t_source").alias("x_source"), "e_bucket")
        .join(cut.select(F.col("t_source").alias("c_source"), "cut"),
              F.col("x_source").eqNullSafe(F.col("c_source")), "left"),
        F.col("t_source").eqNullSafe(F.col("x_source")), "left")
        .select("t_source", "source_size", "target", "whole",
                # nothing taken inside the bucket: all hashes below it
                F.coalesce("cut", "e_bucket", F.lit("")).alias("cut")))
    picked = _with_plan(hashed, plan)
    return picked.select("_row", F.col("_size").alias("size"), "source_size", "target",
                         (F.col("whole") + (F.col("_hash") <= F.col("cut")).cast("long")).alias("repeats"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """``docs`` plus _size, _source_size, _target, _repeats (times taken)."""
    return unboxed(planned(docs, **options), _size=F.col("size"), _source_size=F.col("source_size"),
                   _target=F.col("target"), _repeats=F.col("repeats"))


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    return unboxed(planned(docs, **options).filter("repeats > 0")
                   .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("repeats").cast("int")))))


MIX_SQL = r"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
         md5('mix:' || coalesce(cast(doc_id as varchar), '')) as h
  from DOCS),
src as (select source, sum(size)::double as ss,
               [5.0, 2.0, 1.0][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::double as w
        from d group by source),
r as (select *, row_number() over o as k, coalesce(sum(ss * 3) over (o rows between unbounded preceding and 1 preceding), 0) as before,
             sum(w) over (o rows between current row and unbounded following) as wrest,
             sum(ss) over () as total from src window o as (order by ss * 3 / w, source nulls last)),
lev as (select coalesce(arg_min((total - before) / wrest, k) filter ((total - before) / wrest * w <= ss * 3), 0) as level from r),
t as (select source, ss::bigint as ss, least(ss * 3, level * w) as target from src, lev),
p as (select *, case when ss > 0 then floor(target / ss)::bigint else 0 end as whole from t),
q as (select *, target - whole * ss as part from p),
hh as (select source, h, sum(size) as hs from d group by source, h),
cum as (select hh.source, h, part, sum(hs) over (partition by hh.source order by h) as fin, hs
        from hh join q on hh.source is not distinct from q.source),
cut as (select source, max(h) as cut from cum
        where fin - hs < part and (fin < part or fin - part <= part - (fin - hs)) group by source),
mixed as (select d.*, ss as source_size, target, whole + case when h <= coalesce(cut, '') then 1 else 0 end as repeats
        from d join q on d.source is not distinct from q.source
        left join cut on d.source is not distinct from cut.source)
"""

OP3_SQL = MIX_SQL.replace("DOCS", "documents") + """
select doc_id, size::bigint as size, source_size::bigint as source_size, target,
       (size * repeats)::bigint as taken from mixed"""


@query("op3_mix_sources", OP3_SQL)
def op3_mix_sources(spark, sf_dir):
    """All documents mixed by their sources' weights."""
    return (mix(table(spark, sf_dir, "documents"))
            .select("doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
                    F.col("_target").alias("target"), (F.col("_size") * F.col("_repeats")).alias("taken")))
