"""Percent slices of splits and the epoch-slice schedule of training runs.

A split's rows are numbered by a key order (``ordering.group_row_index``);
a percent range [a, b) becomes the row range [round(n a/100), round(n b/100))
with half-to-even rounding.  A schedule is a table (epoch, begin_pct,
end_pct), or one of row ranges for slices finer than a percent; it may have
any number of rows and is matched with the data by an interval join.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslens.operators.intervals import interval_join
from corpuslens.operators.ordering import group_row_index


def epoch_schedule(data_split: float, epochs: int = 1, mode: str = "compat") -> list[tuple[int, int, int]]:
    """[(epoch, begin_pct, end_pct)], epochs numbered from 1.

    compat: the original truncating arithmetic (slices may overlap by 1 % or
    leave 1 % gaps); exact: each slice ends where the next begins.
    """
    if not 0 < data_split:
        raise ValueError("data_split must be positive")
    split_epochs = math.ceil(1 / data_split)
    needed = max(split_epochs * epochs, epochs)
    out = []
    # The slice arithmetic whose numbers compat mode must give
    for trained in range(needed):
        begin = int(trained % split_epochs * data_split * 100)
        end = int(min(begin + data_split * 100, 100))
        out.append((trained + 1, begin, end))
    if mode == "exact":
        # slice i of a cycle is [b(i), b(i + 1)), the last one ends at 100;
        # b(i) drops float noise (29 * 0.01 * 100 is 28.999...) before flooring
        def b(i):
            return min(int(math.floor(i * data_split * 100 + 1e-9)), 100)
        out = []
        for trained in range(needed):
            i = trained % split_epochs
            out.append((trained + 1, b(i), 100 if i == split_epochs - 1 else b(i + 1)))
    elif mode != "compat":
        raise ValueError("mode must be 'compat' or 'exact'")
    return out


def indexed_splits(df: DataFrame, split_col: str, key: str) -> DataFrame:
    """Rows with ``idx`` (0-based within split, by key) and ``group_rows`` = n."""
    return group_row_index(df, [split_col], [key], "idx")


def percent_slice(indexed: DataFrame, splits: Sequence[str], begin_pct: float, end_pct: float,
                  split_col: str = "split") -> DataFrame:
    """``split[a%:b%]`` for each split, unioned (one filter over indexed rows)."""
    n = F.col("group_rows")
    lo, hi = _pct_row(n, F.lit(float(begin_pct))), _pct_row(n, F.lit(float(end_pct)))
    return indexed.where(F.col(split_col).isin(list(splits)) & (F.col("idx") >= lo) & (F.col("idx") < hi))


def schedule_table(spark: SparkSession, data_split: float, epochs: int = 1, mode: str = "compat") -> DataFrame:
    """(epoch, begin_pct, end_pct) of ``epoch_schedule`` as a table; the
    slices of one cycle are made on the driver, the cycles by Spark."""
    cycle = epoch_schedule(data_split, 1, mode)
    one = spark.createDataFrame(cycle, "slice int, begin_pct int, end_pct int")
    n = len(cycle)
    turns = spark.range(max(epochs, 1)).select(F.col("id").alias("turn"))
    # epochs x slices of a cycle: the schedule itself
    return (turns.withColumn("slice", F.explode(F.sequence(F.lit(1), F.lit(n)))).join(F.broadcast(one), "slice")
            .select((F.col("turn") * n + F.col("slice")).cast("int").alias("epoch"), "begin_pct", "end_pct"))


def row_schedule(counts: DataFrame, slices: int, epochs: int = 1) -> DataFrame:
    """(split, n_rows, epoch, begin_row, end_row): every split of
    ``counts(split, n_rows)`` cut into ``slices`` ranges whose sizes differ by
    one row at most, once per epoch of the cycle.  Finer than percents."""
    i = F.pmod(F.col("epoch") - 1, F.lit(slices)).cast("bigint")
    return (counts.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(slices * epochs))))
            .select("split", "n_rows", "epoch", F.floor(F.col("n_rows") * i / slices).alias("begin_row"),
                    F.floor(F.col("n_rows") * (i + 1) / slices).alias("end_row")))


def _pct_row(n, pct):
    return F.bround(n.cast("double") * pct / F.lit(100.0), 0).cast("bigint")


def schedule_frame(counts: DataFrame, schedule: DataFrame) -> DataFrame:
    """(split, n_rows, epoch, begin_pct, end_pct, begin_row, end_row) per
    split and row of ``schedule``; ``counts`` has one row per split."""
    n = F.col("n_rows")
    # a row of the schedule holds for every split: one value, a few entries
    every = counts.agg(F.collect_list(F.struct("split", "n_rows"))).scalar()
    return schedule.withColumn("_of", F.explode(every)).select("*", "_of.*").select(
        "split", "n_rows", "epoch", "begin_pct", "end_pct",
        _pct_row(n, F.col("begin_pct")).alias("begin_row"), _pct_row(n, F.col("end_pct")).alias("end_row"))


def split_counts(rows: DataFrame, split_col: str = "split") -> DataFrame:
    return rows.groupBy(F.col(split_col).alias("split")).agg(F.count(F.lit(1)).alias("n_rows"))


def assign_epochs(indexed: DataFrame, ranges: DataFrame) -> DataFrame:
    """Rows of ``indexed(split, idx, ...)`` with ``epoch``, once for each of
    the ``ranges(split, epoch, begin_row, end_row)`` that holds them (none in
    a gap)."""
    wanted = ranges.select("split", "epoch", "begin_row", "end_row")
    return interval_join(indexed, wanted, "idx", "begin_row", "end_row", on=["split"]).drop("begin_row", "end_row")
