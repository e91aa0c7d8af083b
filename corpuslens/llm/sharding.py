"""Sharding by histogram sort.

Rows are ordered by (XXH64 of the text, doc_id), so equal texts lie side by
side.  Boundaries of the shards are found by probing: each round counts, over
all partitions, the exact bytes and rows below every candidate key; for each
wanted boundary the two neighbours of its target are then probed more finely,
until a boundary meets the tolerance or no key lies between.  Only these
counts (a few per boundary) reach the driver.  Then every row is exchanged
once, to its place.

Law ``bytes``: shard i ends as near as its keys allow to i/n of all bytes.  A
group of equal texts stays whole if it holds at most ``group_share`` of a
shard, or no more than the largest document; a larger one is split by doc_id,
so that a text which fills a third of the table can't unbalance the shards.

Besides the shards' own boundaries the same search sets finer ones, so that
each exchange partition holds about as much as its neighbours whatever the
number of shards, and slots follow from the counts without another pass.

Defined results: null and empty texts have size 1 and are equal; null doc_id
sorts first; rows equal in text and doc_id can't be told apart and share a
shard; an empty table gives an empty result; extra columns are carried along.
"""

from __future__ import annotations

import bisect

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.common import boxed, empty_if_null, prepared, query, saved, table, unboxed

SHARDS = 16
#: a boundary may miss its target by this share of a shard before it is refined
TOLERANCE = 0.001
#: the same for boundaries inside a shard, which only divide the work
INNER_TOLERANCE = 0.2
GROUP_SHARE = 0.05
PROBES = 16
LOWEST = -(1 << 63)

_COUNT = "i int, bytes long, rows long, h0 long, h1 long, d0 long, d1 long"


def place(h: np.ndarray, d: np.ndarray, keys: list[tuple[int, int]]) -> np.ndarray:
    """Number of ``keys`` that are <= (h, d), for each row."""
    kh = np.array([k[0] for k in keys], np.int64)
    kd = np.array([k[1] for k in keys], np.int64)
    out = np.searchsorted(kh, h, "left")
    on = np.flatnonzero(np.searchsorted(kh, h, "right") > out)
    if len(on):  # rows on a key's own hash, maybe many copies of one text
        ids = np.unique(kd)
        # (first key of the hash, rank of the id) as one number
        codes = np.searchsorted(kh, kh, "left") * (len(ids) + 2) + np.searchsorted(ids, kd, "left") + 1
        out[on] = np.searchsorted(codes, out[on] * (len(ids) + 2) + np.searchsorted(ids, d[on], "right"), "right")
    return out


def _counter(keys):
    def run(batches):
        n = len(keys) + 1
        total, rows = np.zeros(n, np.int64), np.zeros(n, np.int64)
        low = np.full((2, n), np.iinfo(np.int64).max)
        high = np.full((2, n), np.iinfo(np.int64).min)
        for b in batches:
            h, d, size = (b.column(i).to_numpy() for i in range(3))
            i = place(h, d, keys)
            np.add.at(total, i, size)
            np.add.at(rows, i, 1)
            for k, x in enumerate((h, d)):
                np.minimum.at(low[k], i, x)
                np.maximum.at(high[k], i, x)
        at = np.flatnonzero(rows)
        yield pa.RecordBatch.from_pydict({
            "i": pa.array(at, pa.int32()), "bytes": total[at], "rows": rows[at], "h0": low[0, at],
            "h1": high[0, at], "d0": low[1, at], "d1": high[1, at]})
    return run


def count_between(narrow: DataFrame, keys: list[tuple[int, int]]) -> dict[int, tuple]:
    """Exact (bytes, rows, extent of h and d) between neighbouring keys."""
    got = (narrow.mapInArrow(_counter(keys), _COUNT).groupBy("i")
           .agg(F.sum("bytes"), F.sum("rows"), F.min("h0"), F.max("h1"), F.min("d0"), F.max("d1")).collect())
    return {r[0]: tuple(r[1:]) for r in got}


class _Span:
    """Keys from ``key`` (bytes and rows below it) up to the next span's."""

    __slots__ = ("key", "below", "rows_below", "bytes", "rows", "h0", "h1", "d0", "d1")

    def __init__(self, key, below, rows_below, found):
        self.key, self.below, self.rows_below = key, below, rows_below
        self.bytes, self.rows, self.h0, self.h1, self.d0, self.d1 = found

    @property
    def one_group(self):
        return self.h0 == self.h1

    def probes(self, split_groups):
        """Keys inside this span, evenly spaced over the extent of its rows."""
        if self.rows <= 1:
            return []
        if not self.one_group:
            step = (self.h1 - self.h0) / (PROBES + 1)
            inner = {(self.h0 + 1 + int(step * i), LOWEST) for i in range(PROBES + 1)} | {(self.h1, LOWEST)}
            return [k for k in inner if self.h0 < k[0] <= self.h1]
        if split_groups and self.d0 < self.d1:
            step = (self.d1 - self.d0) / (PROBES + 1)
            inner = {(self.h0, self.d0 + 1 + int(step * i)) for i in range(PROBES + 1)} | {(self.h0, self.d1)}
            return [k for k in inner if self.d0 < k[1] <= self.d1]
        return []


def split(narrow: DataFrame, shards: int, parts: int, tolerance=TOLERANCE, group_share=GROUP_SHARE):
    """Boundaries over ``narrow(_h, _d, _size)``: per exchange part its first
    key, the shard it belongs to and the number of rows of that shard before
    it."""
    found = count_between(narrow, [])
    if not found:
        return []
    spans = [_Span((LOWEST, LOWEST), 0, 0, found[0])]
    total = spans[0].bytes
    inner = max(1, parts // shards)
    shard_bytes = total / shards
    whole = max(shard_bytes * group_share, narrow.agg(F.max("_size")).first()[0])
    wanted = [(total * i / (shards * inner), i % inner == 0) for i in range(1, shards * inner)]
    while True:
        starts = [s.below for s in spans]
        probes = set()
        for target, outer in wanted:
            s = spans[bisect.bisect_right(starts, target) - 1]
            miss = min(target - s.below, s.below + s.bytes - target)
            allowed = shard_bytes * (tolerance if outer else INNER_TOLERANCE / inner)
            if miss > allowed:
                probes.update(s.probes(split_groups=s.bytes > (whole if outer else shard_bytes / inner)))
        if not probes:
            break
        keys = sorted({s.key for s in spans[1:]} | probes)
        found = count_between(narrow, keys)
        spans, below, rows = [], 0, 0
        for i, key in enumerate([(LOWEST, LOWEST), *keys]):
            if i in found:  # keys without rows between them and the next are dropped
                spans.append(_Span(key, below, rows, found[i]))
                below, rows = below + found[i][0], rows + found[i][1]
        spans[0].key = (LOWEST, LOWEST)
    starts = [s.below for s in spans]
    out, shard = [(spans[0].key, 0, 0)], 0
    first_row = 0
    for n, (target, outer) in enumerate(wanted, 1):
        at = bisect.bisect_right(starts, target) - 1
        if at + 1 < len(spans) and spans[at + 1].below - target < target - spans[at].below:
            at += 1
        if outer and spans[at].key[1] != LOWEST:
            # inner boundaries may cut a group that the shards keep whole
            first, after = at, at
            while spans[first].key[1] != LOWEST:
                first -= 1
            while after < len(spans) and spans[after].key[0] == spans[at].key[0]:
                after += 1
            stop = spans[after].below if after < len(spans) else total
            if stop - spans[first].below <= whole:
                at = after if stop - target < target - spans[first].below and after < len(spans) else first
        s = spans[at]
        if outer:
            # an empty shard keeps its number: later parts carry the higher one
            shard, first_row = n // inner, s.rows_below
        if s.key == out[-1][0]:
            out[-1] = (s.key, shard, s.rows_below - first_row)
        elif s.key > out[-1][0]:
            out.append((s.key, shard, s.rows_below - first_row))
    return out


def shard_rows(docs: DataFrame, shards: int = SHARDS, parts: int | None = None) -> DataFrame:
    """``docs`` with _size, _shard and _slot, exchanged once into place."""
    n = prepared(docs.sparkSession)
    text = empty_if_null("_row.text")
    keyed = boxed(docs).withColumns({
        "_h": F.xxhash64(text), "_d": F.coalesce(F.col("_row.doc_id").cast("long"), F.lit(LOWEST)),
        "_size": F.octet_length(text).cast("long") + 1})
    parts = shards * -(-max(parts or n, 1) // shards)
    plan = split(saved(keyed.select("_h", "_d", "_size")), shards, parts)
    if not plan:
        return unboxed(keyed, _size=F.col("_size"), _shard=F.lit(0), _slot=F.lit(0).cast("long"))
    keys = [k for k, _, _ in plan[1:]]

    @F.pandas_udf("int")
    def part(h: pd.Series, d: pd.Series) -> pd.Series:
        return pd.Series(place(h.to_numpy(np.int64), d.to_numpy(np.int64), keys).astype(np.int32))

    placed = (keyed.withColumn("_part", part("_h", "_d"))
              .repartitionById(len(plan), "_part").sortWithinPartitions("_h", "_d"))
    shard_of = F.element_at(F.array(*[F.lit(s) for _, s, _ in plan]), F.col("_part") + 1)
    before = F.element_at(F.array(*[F.lit(b).cast("long") for _, _, b in plan]), F.col("_part") + 1)
    # one part is one sorted partition: the low 33 bits count its rows
    position = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    return unboxed(placed.withColumn("_position", position), _size=F.col("_size"), _shard=shard_of,
                   _slot=before + F.col("_position"))


@query("op9_histogram_shards")
def op9_histogram_shards(spark, sf_dir):
    """All documents in 16 shards of near equal bytes."""
    return shard_rows(table(spark, sf_dir, "documents")).select(
        "doc_id", F.col("_size").alias("size"), F.crc32(empty_if_null().cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"), F.col("_shard").alias("shard"), F.col("_slot").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
