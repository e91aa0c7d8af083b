"""Box numbers from mergeable quantile sketches kept by slice (A6 at scale).

``stats.box_stats`` is exact and sorts all values each time.  Here every slice
of a table (a day, a split, a delivery) is summarised once, per group, by a
KLL sketch (Karnin, Lang and Liberty 2016; Spark's own aggregate, so no row
leaves the JVM).  Sketches merge without loss of their guarantee, so adding a
slice costs that slice, and numbers over any choice of slices cost one row per
slice and group.

Error: with probability 0.99 a value returned for the share p has its rank
within ``RANK_ERROR`` of p (normalised; 2.296 / k^0.9021, k = ``K``).  Counts,
minima and maxima are exact.  A group of at most K values is exact too but for
interpolation: a quantile is always one of the values.

Defined results: null values are not counted; groups without values have no
sketch; a slice written twice replaces itself; no slices give no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.operators.stats import FENCE_BYTES, LIST_BYTES, QUARTILES, WHISKER_IQR
from corpuslens.session import cut_lineage

#: size of a sketch; about 4 K doubles, whatever the number of values
K = 512
# Fixed value: the published error bound of a sketch of this size.
RANK_ERROR = 2.296 / K ** 0.9021
NAMES = ("q1", "median", "q3")


def slice_sketches(df: DataFrame, group_cols: Sequence[str], slice_col: str, value_col: str, k: int = K) -> DataFrame:
    """One row per (group, slice): n, low, high and the sketch."""
    v = F.col(value_col).cast("double")
    return (df.where(v.isNotNull()).groupBy(*group_cols, slice_col)
            .agg(F.count(F.lit(1)).alias("n"), F.min(v).alias("low"), F.max(v).alias("high"),
                 F.kll_sketch_agg_double(v, F.lit(k)).alias("sketch")))


def write_slices(sketches: DataFrame, path: str, slice_col: str = "slice") -> None:
    """Store sketches in a folder per slice; only the slices given are replaced."""
    (sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(slice_col).parquet(path))


def merged(sketches: DataFrame, group_cols: Sequence[str], k: int = K) -> DataFrame:
    """One row per group over all slices given."""
    return sketches.groupBy(*group_cols).agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"),
                                             F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def _quantiles(shares: Sequence[float]) -> F.Column:
    return F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(float(p)) for p in shares]))


def box(whole: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """n, q1, median, q3 and whiskers per group.  A whisker is the first value
    inside the fence among the sketch's quantiles at ``K`` even shares and
    the exact minimum and maximum."""
    q = whole.select(*group_cols, "n", "low", "high", _quantiles(QUARTILES).alias("_q"),
                     _quantiles([i / K for i in range(K + 1)]).alias("_all"))
    q = q.withColumns({name: F.get("_q", F.lit(i)) for i, name in enumerate(NAMES)})
    reach = WHISKER_IQR * (F.col("q3") - F.col("q1"))
    every = F.concat(F.array("low", "high"), "_all")
    low = F.array_min(F.filter(every, lambda x: x >= F.col("q1") - reach))
    high = F.array_max(F.filter(every, lambda x: x <= F.col("q3") + reach))
    return q.select(*group_cols, "n", *NAMES, low.alias("whisker_low"), high.alias("whisker_high"))


def exact_ranks(df: DataFrame, numbers: DataFrame, group_cols: Sequence[str], value_col: str,
                names: Sequence[str]) -> DataFrame:
    """Per group n and, for each named number, how many values lie below it
    and how many up to it: one pass that checks an approximation."""
    g = list(group_cols)
    wanted = cut_lineage(numbers.select(*g, *names))
    if wanted.count() * FENCE_BYTES <= LIST_BYTES:  # one row per group
        wanted = F.broadcast(wanted)
    v = F.col(value_col).cast("double")
    counts = [f for c in names for f in (F.sum((v < F.col(c)).cast("bigint")).alias(f"{c}_below"),
                                         F.sum((v <= F.col(c)).cast("bigint")).alias(f"{c}_upto"))]
    return df.where(v.isNotNull()).join(wanted, g).groupBy(*g).agg(F.count(F.lit(1)).alias("n"), *counts)
