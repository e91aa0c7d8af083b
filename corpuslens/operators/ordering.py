"""Dense row numbers over a global order without a single-partition window.

``row_index`` sorts with Spark's range-partitioned sort, materialises the
sorted data once in the shared checkpoint folder (so both passes below see
the same partitions), counts rows per partition (one row per partition),
turns the counts into offsets, and adds the in-partition position that
``monotonically_increasing_id`` already encodes.  Every step is parallel;
the only single-task work is a running sum over as many rows as there are
partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.session import cut_lineage


def _placed(df: DataFrame, order_cols: Sequence[str]) -> DataFrame:
    """Sorted rows with the partition they are in and their place in it."""
    ordered = cut_lineage(df.orderBy(*order_cols))
    return ordered.select("*", F.spark_partition_id().alias("_pid"), F.monotonically_increasing_id().alias("_mid"))


def row_index(df: DataFrame, order_cols: Sequence[str], index_col: str = "idx") -> DataFrame:
    """Add a 0-based dense index following ``order_cols`` (ties: arbitrary)."""
    tagged = _placed(df, order_cols)
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_c"), F.min("_mid").alias("_m0"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = counts.select("_pid", "_m0", (F.sum("_c").over(w) - F.col("_c")).alias("_off"))
    # one row per partition: a size bound fixed by the partition count
    out = tagged.join(F.broadcast(offsets), "_pid")
    return out.withColumn(index_col, F.col("_off") + F.col("_mid") - F.col("_m0")) \
        .drop("_pid", "_mid", "_m0", "_off")


def group_row_index(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                    index_col: str = "idx") -> DataFrame:
    """0-based index restarting in every group, and ``group_rows``.

    In sorted data a group lies in neighbouring partitions, so there is one
    count per group and one more per partition border.  These counts, not the
    rows, are grouped; Spark broadcasts them if they are few.
    """
    g = list(group_cols)
    tagged = _placed(df, g + list(order_cols))
    counts = tagged.groupBy(*g, "_pid").agg(F.count(F.lit(1)).alias("_c"), F.min("_mid").alias("_m0"))
    before = Window.partitionBy(*g).orderBy("_pid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = counts.select(*g, "_pid", "_m0", (F.sum("_c").over(before) - F.col("_c")).alias("_off"),
                           F.sum("_c").over(Window.partitionBy(*g)).alias("group_rows"))
    return tagged.join(starts, [*g, "_pid"]).withColumn(index_col, F.col("_off") + F.col("_mid") - F.col("_m0")) \
        .drop("_pid", "_mid", "_m0", "_off")
