"""Interval join: every point with every half-open interval that holds it.

Spark plans ``begin <= x and x < end`` as a nested loop, or as a join on the
other keys whose candidates are all pairs.  Here both sides get an equality
key.  An interval of up to 2^k lies at level k, where the line is cut into
bins of 2^k / SPREAD; it has a row for each bin that it touches (at most
SPREAD + 1), and a point one row per level, in the bin that holds it.  Rows
that share (keys, level, bin) meet, and the exact bounds decide.

So long and short intervals may be mixed, no interval is repeated without
limit, and one that covers every point is spread over SPREAD bins.  There are
at most 64 levels; which ones occur is all that reaches the driver.

Defined results: an interval with end <= begin, and null points, bounds or
keys, match nothing; equal intervals match each; an empty side gives nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: bins that an interval of full length touches, less one; a power of two
SPREAD = 64
_SPREAD_BITS = SPREAD.bit_length() - 1


def _level(length):
    """Smallest k with 2^k >= length."""
    return F.when(length <= 1, 0).otherwise(F.length(F.bin(length - 1))).cast("int")


def _bin_bits(level):
    """Bits that a bin of this level drops."""
    return F.greatest(level - _SPREAD_BITS, F.lit(0))


def _shifted(value, bits):
    return F.call_function("shiftright", value, bits)


def interval_join(points: DataFrame, intervals: DataFrame, point: str, begin: str, end: str,
                  on: Sequence[str] = ()) -> DataFrame:
    """All columns of ``points`` and of ``intervals`` (integer bounds) for
    ``begin <= point < end`` and equal ``on`` columns, which appear once."""
    on = list(on)
    spans = intervals.where(F.col(end) > F.col(begin)).withColumn(
        "_level", _level(F.col(end).cast("bigint") - F.col(begin).cast("bigint")))
    levels = sorted(r[0] for r in spans.select("_level").distinct().collect())
    bits = _bin_bits(F.col("_level"))
    spans = spans.withColumn("_bin", F.explode(F.sequence(
        _shifted(F.col(begin).cast("bigint"), bits), _shifted(F.col(end).cast("bigint") - 1, bits))))
    at = F.array(*[F.lit(k) for k in levels]).cast("array<int>")
    dots = points.withColumn("_level", F.explode(at)).withColumn(
        "_bin", _shifted(F.col(point).cast("bigint"), _bin_bits(F.col("_level"))))
    met = dots.join(spans, [*on, "_level", "_bin"])
    return met.where((F.col(point) >= F.col(begin)) & (F.col(point) < F.col(end))).drop("_level", "_bin")
