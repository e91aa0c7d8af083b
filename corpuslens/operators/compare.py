"""Comparison of two metric series (metric, value): alignment on a fixed
metric order, differences, common metrics and direction-aware win tallies.

All inputs are small (one row per metric); they are still ordinary joins so
the same code compares per-group series when a group column is added.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def diff_table(a: DataFrame, b: DataFrame, order: Sequence[str]) -> DataFrame:
    """(ord, metric, a, b, diff = b - a) conformed to ``order``.

    Metrics outside ``order`` are dropped; metrics absent from a side give
    null for that side and for ``diff``.
    """
    both = a.join(b, "metric", "full_outer")
    spark = a.sparkSession
    dim = spark.createDataFrame([(i + 1, m) for i, m in enumerate(order)], "ord int, metric string")
    out = dim.join(both, "metric", "left")
    return out.select("ord", "metric", "a", "b", (F.col("b") - F.col("a")).alias("diff"))


def common_metrics(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.join(b, "metric", "inner").select("metric")


def _winner_flag(lower_is_better: Sequence[str]):
    lower = F.col("metric").isin(list(lower_is_better))
    return F.when(lower, F.col("a") < F.col("b")).otherwise(F.col("a") > F.col("b"))


def pairwise_wins(a: DataFrame, b: DataFrame, lower_is_better: Sequence[str],
                  name_a: str = "Method 1", name_b: str = "Method 2") -> DataFrame:
    """Tally of metrics each side wins; equal values count for nobody."""
    c = a.join(b, "metric", "inner").withColumn("a_wins", _winner_flag(lower_is_better))
    t = c.agg(F.count(F.lit(1)).alias("n_common"),
              F.coalesce(F.sum(F.col("a_wins").cast("bigint")), F.lit(0).cast("bigint")).alias("wins_a"),
              F.coalesce(F.sum(((F.col("a") != F.col("b")) & ~F.col("a_wins")).cast("bigint")),
                         F.lit(0).cast("bigint")).alias("wins_b"))
    verdict = (F.when(F.col("wins_a") > F.col("wins_b"), F.lit(name_a))
               .when(F.col("wins_b") > F.col("wins_a"), F.lit(name_b)).otherwise(F.lit("Tie")))
    return t.select("n_common", "wins_a", "wins_b", verdict.alias("verdict"))


def pairwise_long(a: DataFrame, b: DataFrame, name_a: str, name_b: str) -> DataFrame:
    """(metric, method, value) for the metrics both sides report."""
    c = a.join(b, "metric", "inner")
    return (c.select("metric", F.lit(name_a).alias("method"), F.col("a").alias("value"))
            .unionByName(c.select("metric", F.lit(name_b).alias("method"), F.col("b").alias("value"))))
