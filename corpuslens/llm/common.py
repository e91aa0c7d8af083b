"""Helpers shared by the operators of this package."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslens.session import cut_lineage, ship_package

#: fixed value: white space of the contracts, [\x20\x09-\x0D], which is also
#: what ``bytes.split()`` splits on
SPACE = " \t\n\x0b\f\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(key: str, oracle: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``key``."""
    def deco(fn):
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: rows of an Arrow batch: whole texts are rows here, so Spark's default of
#: 10,000 would hold tens of megabytes on either side of each worker
BATCH_ROWS = 1000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def prepared(spark: SparkSession) -> int:
    """Ship the package to the Python workers, bound their batches (smaller
    settings stay); return the shuffle width."""
    ship_package(spark)
    if not 0 < int(spark.conf.get(_BATCH_SETTING)) <= BATCH_ROWS:
        spark.conf.set(_BATCH_SETTING, str(BATCH_ROWS))
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def saved(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the session's shared folder."""
    return cut_lineage(df)


#: a table is broadcast only if its counted rows stay below this
BROADCAST_BYTES = 16 << 20


def sized(df: DataFrame, row_bytes: int) -> DataFrame:
    """``df`` (a checkpoint) with a broadcast hint if its counted size is
    small; else as it is, for a shuffled join that AQE can split."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def boxed(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` as one struct ``_row``, so that no helper
    column can clash with them; ``unboxed`` gives them back."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))


def unboxed(df: DataFrame, **more) -> DataFrame:
    """The boxed columns plus ``more``, which take the place of columns that
    have the same names."""
    names = [f.name for f in df.schema["_row"].dataType.fields if f.name.lower() not in more]
    return df.select(*[F.col(f"_row.`{c}`") for c in names], *[c.alias(k) for k, c in more.items()])


_GAP = re.compile(rb"[ \t-\r]")


def at_gaps(body: bytes, size: int):
    """Parts of ``body`` of about ``size`` bytes, cut at white space only."""
    start = 0
    while len(body) - start > size:
        gap = _GAP.search(body, start + size)
        if gap is None:
            break
        yield body[start:gap.start()]
        start = gap.end()
    yield body[start:]


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spanning stars of the links a[i]-b[i]: (node, smallest node of its part).

    Roots are left out, so the result has fewer rows than there are nodes,
    however many links came in.
    """
    if len(a) == 0:
        return a[:0], b[:0]
    ids, inv = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = inv[:len(a)], inv[len(a):]
    lab = np.arange(len(ids))
    while True:
        lu, lv = lab[u], lab[v]
        differ = lu != lv
        if not differ.any():
            break
        u, v, lu, lv = u[differ], v[differ], lu[differ], lv[differ]
        low = np.minimum(lu, lv)
        np.minimum.at(lab, np.maximum(lu, lv), low)
        while True:
            up = lab[lab]
            if np.array_equal(up, lab):
                break
            lab = up
    child = np.flatnonzero(lab != np.arange(len(ids)))
    return ids[child], ids[lab[child]]


def runs(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of every run of equal values in a sorted array."""
    if len(sorted_keys) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start = np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]))
    return start, np.diff(np.concatenate([start, [len(sorted_keys)]]))


def empty_if_null(name: str = "text"):
    return F.coalesce(F.col(name).cast("string"), F.lit(""))
