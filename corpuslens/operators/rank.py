"""Ordering of scored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sort_by_score(df: DataFrame, score_col: str = "score", tie_break: str = "model") -> DataFrame:
    """Best first; null (NaN) scores last; ties broken by ``tie_break``.

    A global sort is a range-partitioned shuffle in Spark: it scales, and the
    tables ranked here have one row per model.
    """
    return df.orderBy(F.col(f"`{score_col}`").desc_nulls_last(), F.col(f"`{tie_break}`").asc_nulls_last())
