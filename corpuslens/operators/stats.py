"""Corpus statistics: per-text counts, grouped box-plot numbers, common-bin
histograms, word frequencies and seeded sampling.

Scale notes
* ``box_stats`` is exact without gathering a group: values are first reduced
  to a (group, value, count) histogram with map-side combining, which is then
  ranked over range-sorted partitions.
* Histograms take the global min/max as one scalar subquery.
* Frequencies aggregate with partial (map-side) combining; a hot word sends
  one row per map task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.functions import segment
from corpuslens.session import cut_lineage

# Fixed value: Tukey's whisker factor.
WHISKER_IQR = 1.5
QUARTILES = (0.25, 0.5, 0.75)
# Bytes of a table that may be sent to every task, and of a row
# of fences.
LIST_BYTES, FENCE_BYTES = 8 << 20, 200


def text_stats(col) -> dict[str, Column]:
    """tokens, sentences and mean tokens per sentence (0 without sentences)."""
    c = F.col(col) if isinstance(col, str) else col
    sents = segment.sentences(c)
    per_sent = F.transform(sents, lambda s: F.size(segment.tokens(s)).cast("bigint"))
    total = F.aggregate(per_sent, F.lit(0).cast("bigint"), lambda a, b: a + b)
    n = F.size(sents)
    return {
        "tokens": F.size(segment.tokens(c)).cast("bigint"),
        "sentences": n.cast("bigint"),
        "avg_sent_len": F.coalesce(F.try_divide(total.cast("double"), n.cast("double")), F.lit(0.0)),
    }


def box_stats(df: DataFrame, group_cols: Sequence[str], value_col: str) -> DataFrame:
    """n, q1, median, q3 and IQR whiskers (outliers excluded) per group -- exact.

    Values are counted first, then sorted over all partitions; a running count
    per partition plus the counts of earlier partitions gives each value its
    ranks.  So a group of distinct doubles is spread like any other rows.
    """
    g = list(group_cols)
    hist = (df.where(F.col(value_col).isNotNull())
            .groupBy(*g, F.col(value_col).cast("double").alias("v")).agg(F.count(F.lit(1)).alias("c")))
    placed = cut_lineage(hist.orderBy(*g, "v").withColumn("_pid", F.spark_partition_id()))
    totals = placed.groupBy(*g, "_pid").agg(F.sum("c").alias("_c"))
    earlier = Window.partitionBy(*g).orderBy("_pid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = totals.select(*g, "_pid", (F.sum("_c").over(earlier) - F.col("_c")).alias("_off"),
                           F.sum("_c").over(Window.partitionBy(*g)).alias("n"))
    inside = Window.partitionBy(*g, "_pid").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = (placed.withColumn("_in", F.sum("c").over(inside)).join(starts, [*g, "_pid"])
           .withColumn("cum", F.col("_off") + F.col("_in")).withColumn("before", F.col("cum") - F.col("c")))
    aggs = []
    for i, p in enumerate(QUARTILES):
        pos = F.lit(p) * (F.col("n") - 1).cast("double")
        for side, rank in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            # the value at 0-based rank k is v where before <= k < cum
            aggs.append(F.max(F.when((F.col("before") <= rank) & (rank < F.col("cum")), F.col("v"))).alias(f"_{side}{i}"))
    q = cum.groupBy(*g, "n").agg(*aggs)
    for i, (p, name) in enumerate(zip(QUARTILES, ("q1", "median", "q3"))):
        pos = F.lit(p) * (F.col("n") - 1).cast("double")
        q = q.withColumn(name, F.col(f"_lo{i}") + (pos - F.floor(pos)) * (F.col(f"_hi{i}") - F.col(f"_lo{i}")))
    reach = WHISKER_IQR * (F.col("q3") - F.col("q1"))
    q = cut_lineage(q)
    fences = q.withColumns({"_lo_f": F.col("q1") - reach, "_hi_f": F.col("q3") + reach}).select(*g, "_lo_f", "_hi_f")
    if q.count() * FENCE_BYTES <= LIST_BYTES:  # one row per group
        fences = F.broadcast(fences)
    whiskers = (placed.join(fences, g).groupBy(*g)
                .agg(F.min(F.when(F.col("v") >= F.col("_lo_f"), F.col("v"))).alias("whisker_low"),
                     F.max(F.when(F.col("v") <= F.col("_hi_f"), F.col("v"))).alias("whisker_high")))
    return q.join(whiskers, g).select(*g, "n", "q1", "median", "q3", "whisker_low", "whisker_high")


def common_bins(df: DataFrame, value_col: str, bins: int = 20) -> DataFrame:
    """Attach ``bucket`` in 1..bins over the global [min, max] of the column."""
    rng = df.select(F.struct(F.min(value_col).alias("lo"), F.max(value_col).alias("hi"))).scalar()
    lo, hi = rng.getField("lo"), rng.getField("hi")
    x = F.col(value_col)
    width = hi - lo
    raw = F.floor(F.try_divide(x - lo, width) * F.lit(float(bins))).cast("bigint") + 1
    bucket = F.when(width == 0, F.lit(1).cast("bigint")).otherwise(F.least(raw, F.lit(bins).cast("bigint")))
    return (df.where(x.isNotNull())
            .withColumn("bucket", bucket)
            .withColumn("bin_low", lo + (F.col("bucket") - 1) * width / F.lit(float(bins)))
            .withColumn("bin_high", lo + F.col("bucket") * width / F.lit(float(bins))))


def histogram(df: DataFrame, group_cols: Sequence[str], value_col: str, bins: int = 20) -> DataFrame:
    """Counts per (group, common bin); empty bins are absent."""
    binned = common_bins(df, value_col, bins)
    return (binned.groupBy(*group_cols, "bucket")
            .agg(F.first("bin_low").alias("bin_low"), F.first("bin_high").alias("bin_high"),
                 F.count(F.lit(1)).alias("count")))


def histograms(df: DataFrame, group_cols: Sequence[str], values: Mapping[str, str], bins: int = 20) -> DataFrame:
    """``histogram`` of several columns (name -> column) at once, with
    ``score`` = the name: one pass for all ranges, one for all counts."""
    g = list(group_cols)
    ends = [f(c).alias(f"{end}{i}") for i, c in enumerate(values.values()) for end, f in (("lo", F.min), ("hi", F.max))]
    ranged = df.withColumn("_r", df.select(F.struct(*ends)).scalar())
    each = F.array(*[F.struct(F.lit(name).alias("score"), F.col(c).cast("double").alias("v"), F.col(f"_r.lo{i}").alias("lo"),
                              F.col(f"_r.hi{i}").alias("hi")) for i, (name, c) in enumerate(values.items())])
    long = ranged.select(*g, F.inline(each)).where("v is not null")
    width, n = F.col("hi") - F.col("lo"), F.lit(float(bins))
    raw = F.floor(F.try_divide(F.col("v") - F.col("lo"), width) * n).cast("bigint") + 1
    bucket = F.when(width == 0, F.lit(1).cast("bigint")).otherwise(F.least(raw, F.lit(bins).cast("bigint")))
    counts = long.groupBy(*g, "score", "lo", "hi", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("count"))
    return counts.select(*g, "score", "bucket", (F.col("lo") + (F.col("bucket") - 1) * width / n).alias("bin_low"),
                         (F.col("lo") + F.col("bucket") * width / n).alias("bin_high"), "count")


def word_frequencies(docs: DataFrame, text_col: str, stop_words: DataFrame | None = None, top: int = 200) -> DataFrame:
    """Top-``top`` words by count, without the caller's stop words if given."""
    w = docs.select(F.explode(segment.words(text_col)).alias("word"))
    counts = w.groupBy("word").agg(F.count(F.lit(1)).alias("count"))
    if stop_words is not None:
        counts = counts.join(stop_words, "word", "left_anti")
    return counts.orderBy(F.desc("count"), "word").limit(top)


def sample_key(key_col: str, seed: int) -> Column:
    """Repeatable pseudo-random order key, identical in SQL engines with md5."""
    return F.md5(F.concat(F.lit(str(seed)), F.lit(":"), F.col(key_col).cast("string")))


def sample_exact(df: DataFrame, key_col: str, n: int, seed: int = 0) -> DataFrame:
    """Exactly ``n`` rows (all rows if fewer) chosen by a seeded hash order.

    ``orderBy(...).limit(n)`` plans as a distributed top-k: each task keeps
    its best ``n`` and only those reach the final merge.
    """
    return df.withColumn("sample_key", sample_key(key_col, seed)).orderBy("sample_key", key_col).limit(n)


def seeded_shuffle(df: DataFrame, key_col: str, seed: int) -> DataFrame:
    """All rows in a repeatable pseudo-random order (range-partitioned sort)."""
    return df.withColumn("shuffle_key", sample_key(key_col, seed)).orderBy("shuffle_key", key_col)
