"""Reshaping: tagged unions, unpivot (melt), wide-to-long metric tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def concat_tagged(frames: Mapping[str, DataFrame], tag_col: str = "split") -> DataFrame:
    """Union frames by column name, adding a constant column with each name."""
    tagged = [df.withColumn(tag_col, F.lit(name)) for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b), tagged)


def melt(df: DataFrame, ids: Sequence[str], fields: Sequence[str], metric: str,
         var_name: str = "field") -> DataFrame:
    """Unpivot ``{field}_{metric}`` columns to (ids, field, metric).

    The ``_{metric}`` suffix is removed literally (not as a regex).
    """
    cols = [f"{f}_{metric}" for f in fields]
    long = df.unpivot(list(ids), cols, var_name, metric)
    return long.withColumn(var_name, F.replace(F.col(var_name), F.lit(f"_{metric}"), F.lit("")))


def metrics_long(df: DataFrame, id_col: str, metrics: Sequence[str],
                 var_name: str = "metric", value_name: str = "value") -> DataFrame:
    """Wide metric table -> (id, metric, value); null metrics are dropped."""
    present = [m for m in metrics if m in df.columns]
    long = df.select(id_col, *[F.col(f"`{m}`").cast("double").alias(m) for m in present]) \
        .unpivot([id_col], present, var_name, value_name)
    return long.where(F.col(value_name).isNotNull())
