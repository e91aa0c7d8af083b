"""Min-max normalization, row means and category scores of metric tables.

Column ranges are computed by ONE aggregate.  Without groups it is planned
as a single scalar subquery (one struct of all minima and maxima, evaluated
once and inlined as a value); with groups it is a keyed join.  No
un-partitioned window is used, so no task ever has to hold the whole table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens import schema
from corpuslens.session import cut_lineage

ON_CONSTANT = ("null", "zero", "half")


def nan_to_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Turn NaN into null so that min/max/avg skip it like pandas does."""
    return df.withColumns({c: F.when(~F.isnan(F.col(c)), F.col(c)) for c in cols})


def metric_ranges(df: DataFrame, cols: Sequence[str],
                  partition_by: Sequence[str] = ()) -> DataFrame:
    """One row (per group) with ``{c}__min`` and ``{c}__max`` for every column."""
    aggs = []
    for c in cols:
        aggs += [F.min(F.col(f"`{c}`")).alias(f"{c}__min"), F.max(F.col(f"`{c}`")).alias(f"{c}__max")]
    if partition_by:
        return df.groupBy(*partition_by).agg(*aggs)
    return df.agg(*aggs)


def minmax_normalize(df: DataFrame, cols: Sequence[str], lower_is_better: Sequence[str] = (),
                     on_constant: str = "null", flip_after: bool = False,
                     partition_by: Sequence[str] = (), materialize: bool = True) -> DataFrame:
    """Scale every column of ``cols`` present in ``df`` to [0, 1].

    on_constant: what a zero range (max == min) yields --
      ``"null"``  0/0 (the report rule; the value is then skipped by means),
      ``"zero"``  0.0 (the leaderboard rule),
      ``"half"``  0.5 (the notebook rule; also used when a column is all-null).
    Direction: with ``flip_after=False`` lower-is-better columns are scaled as
    ``(max - x) / range``; with ``flip_after=True`` every column is scaled
    upward first and lower-is-better columns become ``1 - x`` afterwards.

    Normalizing reads its input twice (ranges, then values).  With
    ``materialize`` the input is written once to the shared checkpoint
    folder, so an expensive upstream job (e.g. a corpus evaluation) is not
    run twice; metric tables are one row per model, so this is small.
    """
    if on_constant not in ON_CONSTANT:
        raise ValueError(f"on_constant must be one of {ON_CONSTANT}")
    present = [c for c in cols if c in df.columns]
    df = nan_to_null(df, present)
    if materialize:
        df = cut_lineage(df)
    ranges = metric_ranges(df, present, partition_by)
    if partition_by:
        joined = df.join(ranges, list(partition_by), "left")

        def bound(c, s):
            return F.col(f"{c}__{s}")
    else:
        packed = ranges.select(F.struct(*ranges.columns).alias("r")).scalar()
        joined = df

        def bound(c, s):
            return packed.getField(f"{c}__{s}")
    lower = set(lower_is_better)
    exprs = {}
    for c in present:
        x, lo, hi = F.col(f"`{c}`"), bound(c, "min"), bound(c, "max")
        rng = hi - lo
        down = c in lower and not flip_after
        scaled = F.try_divide(hi - x, rng) if down else F.try_divide(x - lo, rng)
        if on_constant == "null":
            val = scaled
        elif on_constant == "zero":
            val = F.when(hi == lo, F.lit(0.0)).otherwise(scaled)
        else:
            val = F.when(hi > lo, scaled).otherwise(F.lit(0.5))
        if flip_after and c in lower:
            val = F.lit(1.0) - val
        exprs[c] = val
    out = joined.withColumns(exprs)
    if partition_by:
        out = out.drop(*[f"{c}__{s}" for c in present for s in ("min", "max")])
    return out


def row_mean(cols: Sequence[str]) -> Column:
    """Mean of the non-null values of ``cols`` in a row; null if none."""
    total = sum((F.coalesce(F.col(f"`{c}`"), F.lit(0.0)) for c in cols), F.lit(0.0))
    n = sum((F.col(f"`{c}`").isNotNull().cast("int") for c in cols), F.lit(0))
    return F.try_divide(total, n.cast("double"))


def category_means(df: DataFrame, names: Sequence[str] = ("relevance", "readability",
                                                          "factuality", "score"),
                   groups: Sequence[Sequence[str]] = (schema.RELEVANCE, schema.READABILITY,
                                                     schema.FACTUALITY)) -> DataFrame:
    """Add one mean column per metric category plus their overall mean."""
    *cat_names, final = names
    out = df.withColumns({n: row_mean(g) for n, g in zip(cat_names, groups)})
    return out.withColumn(final, row_mean(cat_names))
