"""Confidence bands by Poisson bootstrap in one pass (A10, A11).

Resampling n rows with replacement gives each row a count that is nearly
Poisson(1), independently of the others, so a replicate needs no sample: every
row carries a weight for each replicate, drawn from a hash of its key, and one
aggregation sums weights and weighted values per (group, replicate).  Sums
combine map-side, so a group costs REPLICATES rows a task whatever its size;
reruns and other engines draw the same weights.

Defined results: null values are left out; a replicate in which a group has
no weight is left out; rows that share a key share their weights (so a key
should name a row); a group of one row has a band of width 0.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REPLICATES, LEVEL, SEED = 200, 0.95, 7
#: 16-bit numbers in the 32 hex digits of an md5
PER_HASH = 8
#: cumulated Poisson(1) probabilities in 1/65536: a number's weight is how many it reaches
POISSON = [round(65536 * sum(math.exp(-1) / math.factorial(i) for i in range(k + 1))) for k in range(8)]


def _weights(key_col: str, replicates: int, seed: int):
    """array<int>: the Poisson(1) weight of a row in each replicate."""
    hashes = F.transform(F.sequence(F.lit(0), F.lit(-(-replicates // PER_HASH) - 1)), lambda i: F.md5(
        F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(key_col).cast("string"), F.lit("")), i.cast("string"))))

    def weight(j):
        h = F.get(hashes_col, F.floor(j / PER_HASH).cast("int"))
        u = F.conv(F.substring(h, (j % PER_HASH) * 4 + 1, F.lit(4)), 16, 10).cast("int")
        return sum(F.when(u >= c, 1).otherwise(0) for c in POISSON)

    hashes_col = F.col("_hashes")
    return hashes, F.transform(F.sequence(F.lit(0), F.lit(replicates - 1)), weight)


def confidence_band(df: DataFrame, key_col: str, group_cols: Sequence[str], value_col: str,
                    replicates: int = REPLICATES, level: float = LEVEL, seed: int = SEED) -> DataFrame:
    """Per group n, mean and the band (low, high) that holds ``level`` of the
    replicates' means."""
    g = list(group_cols)
    hashes, weights = _weights(key_col, replicates, seed)
    rows = (df.where(F.col(value_col).isNotNull()).select(*g, F.col(value_col).cast("double").alias("_v"), F.col(key_col))
            .withColumn("_hashes", hashes).select(*g, "_v", F.posexplode(weights).alias("_b", "_w")))
    sums = rows.groupBy(*g, "_b").agg(F.count(F.lit(1)).alias("n"), F.avg("_v").alias("mean"), F.sum("_w").alias("_n"),
                                      F.sum(F.col("_w") * F.col("_v")).alias("_s"))
    means = sums.withColumn("_m", F.try_divide(F.col("_s"), F.col("_n")))
    tail = (1 - level) / 2
    # at most ``replicates`` rows a group
    return means.groupBy(*g).agg(F.first("n").alias("n"), F.first("mean").alias("mean"),
                                 F.percentile("_m", F.lit(tail)).alias("low"), F.percentile("_m", F.lit(1 - tail)).alias("high"))


def sql_band(source: str, key: str, groups: Sequence[str], value: str) -> str:
    """The same in SQL: CTEs after ``source``, ending in ``band``."""
    g = ", ".join(groups)
    weight = " + ".join(f"(u >= {c})::int" for c in POISSON)
    return (f"boot_w as (select {g}, v, b, {weight} as w from (select {g}, {value} as v, b, ('0x' || substr(md5('{SEED}:' || "
            f"coalesce({key}::varchar, '') || ':' || (b // {PER_HASH})::varchar), (b % {PER_HASH}) * 4 + 1, 4))::int as u "
            f"from {source}, (select unnest(range({REPLICATES})) as b) where {value} is not null)), "
            f"boot_s as (select {g}, b, count(*) as n, avg(v) as mean, sum(w * v) / nullif(sum(w), 0) as m from boot_w group by {g}, b), "
            f"band as (select {g}, any_value(n) as n, any_value(mean) as mean, quantile_cont(m, {(1 - LEVEL) / 2!r}) as low, "
            f"quantile_cont(m, {1 - (1 - LEVEL) / 2!r}) as high from boot_s group by {g})")
