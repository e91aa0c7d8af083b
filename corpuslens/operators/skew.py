"""Skew-safe joins and per-group top-k.

``salted_join`` spreads every key of the large side over ``salts`` tasks and
replicates the (small, per-key) other side ``salts`` times, so a key holding
a third of all rows is processed by ``salts`` tasks instead of one.  Nothing
is broadcast, so no size bound on the small side is needed.

``top_k_per_group`` ranks inside (group, salt) first and keeps k rows per
sub-group, then ranks the at most ``salts * k`` survivors per group: a hot
group is never sorted by a single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: rows of one key that a task of a salted join or ranking handles.
ROWS_PER_SALT = 100_000


def salts_for(df: DataFrame, keys: Sequence[str], rows_per_salt: int = ROWS_PER_SALT) -> int:
    """How many ways the most frequent key has to be split (one number)."""
    most = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0]
    return max(1, -(-(most or 0) // rows_per_salt))


def salted_join(big: DataFrame, small: DataFrame, keys: Sequence[str], salt_of: Column,
                salts: int, how: str = "inner") -> DataFrame:
    """Join on ``keys`` with the big side split by ``salt_of`` (any column
    expression; it is reduced modulo ``salts``)."""
    b = big.withColumn("_salt", F.pmod(salt_of, F.lit(salts)).cast("int"))
    s = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return b.join(s, list(keys) + ["_salt"], how).drop("_salt")


def top_k_per_group(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column], k: int,
                    salt_of: Column, salts: int, rank_col: str = "rank") -> DataFrame:
    """The best ``k`` rows of every group by ``order`` (ties broken by ``order``)."""
    g = list(group_cols)
    salted = df.withColumn("_salt", F.pmod(salt_of, F.lit(salts)).cast("int"))
    w1 = Window.partitionBy(*g, "_salt").orderBy(*order)
    stage1 = salted.withColumn("_r1", F.row_number().over(w1)).where(F.col("_r1") <= k).drop("_r1", "_salt")
    w2 = Window.partitionBy(*g).orderBy(*order)
    return stage1.withColumn(rank_col, F.row_number().over(w2)).where(F.col(rank_col) <= k)
