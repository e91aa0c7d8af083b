"""Connected components of a link table, wholly as Spark jobs.

Alternating large-star / small-star contraction.  Links are first reduced
to spanning stars inside each partition, so cliques arrive as stars.  The
per-node minima are checkpointed before they are joined back: both join
sides are then plain shuffles and AQE can split a hub that holds a large
share of the links.  Only two numbers per round reach the driver.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.common import forest, prepared, saved

_EDGE = "a long, b long"


def _local_stars(batches):
    """Spanning stars of one partition; holds at most one link per node."""
    a = b = np.zeros(0, np.int64)
    for pdf in batches:
        a, b = forest(np.concatenate([a, pdf["a"].to_numpy(np.int64)]),
                      np.concatenate([b, pdf["b"].to_numpy(np.int64)]))
    yield pd.DataFrame({"a": a, "b": b})


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = saved(both.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
                .select("n", F.least("n", "m").alias("m")))
    return (e.join(low, e["b"] == low["n"]).select("a", F.col("m").alias("b")))


def _small_star(e: DataFrame) -> DataFrame:
    low = saved(e.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m")))
    rest = (e.join(low, e["a"] == low["n"]).filter(F.col("b") > F.col("m"))
            .select(F.col("b").alias("a"), F.col("m").alias("b")))
    return low.select(F.col("n").alias("a"), F.col("m").alias("b")).unionByName(rest).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links(a, b)`` that isn't itself
    the smallest node of its component; null or self links are ignored.
    An empty table gives an empty table."""
    prepared(links.sparkSession)
    e = (links.select(F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b"))
         .filter("a > b").mapInPandas(_local_stars, _EDGE))
    e = saved(e)
    seen = None
    while True:
        mark = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen or mark[0] == 0:
            break
        seen = mark
        e = saved(_small_star(_large_star(e)))
    return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
