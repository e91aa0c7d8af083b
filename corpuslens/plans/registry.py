"""Named queries: key -> Spark builder ``(spark, sf_dir) -> DataFrame``, plus an
optional DuckDB statement computing the same result over the same tables."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(key: str, oracle: str | None = None):
    def deco(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key!r}")
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle
        return fn
    return deco


def r6(col):
    """Round a double column to 6 digits (both engines sum in different orders)."""
    from pyspark.sql import functions as F
    return F.round(col.cast("double") if not isinstance(col, str) else F.col(col).cast("double"), 6)
