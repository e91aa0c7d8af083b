"""SimHash near-dedup over a byte-position inverted index.

A 64-bit fingerprint is eight bytes at eight positions.  Two fingerprints
that differ in at most ``max_bits`` bits differ in at most that many bytes,
so they share at least 8 - max_bits positional bytes: the guaranteed minimum.
For 4 bits that is 4 of 8 positions, hence 3 of the first 7.  The index
therefore has a posting list for every three positional bytes among the first
seven (35 lists a fingerprint), where a pair that can qualify meets at least
once; lists of single positions would hold 1/256 of all fingerprints each.
Within a list all eight positional bytes are tallied for each pair, pairs
that reach the minimum are kept, and their bit distance verifies them.

Equal fingerprints are one entry of the index, however many documents have
them.  A list longer than a block is dealt out as pairs of blocks.  Each task
passes on spanning stars of its links, never the links of a group.

Defined results: null and empty texts have fingerprint zero and link like any
other; rows without doc_id get a fingerprint but no class (component_id
null); repeated rows are alike; rows that share a doc_id but not a text are
judged each by its own fingerprint, so they may be in different classes; an
empty table gives an empty result; extra columns are ignored by
``near_groups`` and carried by ``keep_first``.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.common import at_gaps, boxed, empty_if_null, forest, prepared, query, runs, saved, sized, table, unboxed
from corpuslens.llm.components import connected_components

WORDS, MAX_BITS, SEED = 4, 4, 42
#: entries of a posting list that one task compares with one another
BLOCK = 4096
#: shorter lists are compared by lags over a whole batch, longer ones as matrices
SHORT = 64

_BYTE_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


#: bytes of a text whose shingles are hashed at a time
PART_BYTES = 1 << 22


def _set_bits(w: list[bytes], k: int) -> tuple[np.ndarray, int]:
    """How many ``k``-word shingles of ``w`` set each bit, and their number."""
    body = b" ".join(w)
    length = np.fromiter(map(len, w), np.int64, len(w))
    start = np.cumsum(length + 1) - length - 1
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(body[a:b], SEED) for a, b in
                  zip(start[:len(w) - k + 1].tolist(), (start + length)[k - 1:].tolist(), strict=True)], np.uint64)
    # eight histograms of byte values
    at = h.view(np.uint8).reshape(-1, 8) + (np.arange(8) * 256)
    return (np.bincount(at.ravel(), minlength=2048).reshape(8, 256) @ _BYTE_BITS).ravel(), len(h)


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """SimHash of the word shingles of ``text`` (ASCII lower-cased), unsigned."""
    ones, n, before = np.zeros(64, np.int64), 0, []
    for part in at_gaps(text, PART_BYTES):
        w = before + part.lower().split()
        if len(w) >= words:
            got, more = _set_bits(w, words)
            ones, n = ones + got, n + more
            before = w[len(w) - words + 1:] if words > 1 else []
        else:
            before = w
    if n == 0 and before:  # fewer words than a shingle has
        ones, n = _set_bits(before, len(before))
    bits = (ones * 2 > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def _fingerprints(words):
    def run(batches):
        for b in batches:
            out = [fingerprint(t, words) for t in b.column("body").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(np.array(out, np.uint64).view(np.int64)), b.column("mark")],
                ["doc_id", "fp", "mark"])
    return run


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, fp and ``mark``, a hash of the text that tells rows of one
    doc_id apart."""
    prepared(docs.sparkSession)
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), empty_if_null().cast("binary").alias("body"),
                        F.xxhash64(empty_if_null()).alias("mark"))
            .mapInArrow(_fingerprints(words), "doc_id long, fp long, mark long"))


def posting_keys(fp, max_bits: int = MAX_BITS):
    """Array of the posting lists of ``fp``: combinations of positional bytes
    one short of the guaranteed minimum, over all positions but the last."""
    shared = max(1, 8 - max_bits - 1)
    byte = [F.shiftrightunsigned(fp, 8 * i).bitwiseAND(255) for i in range(7)]
    keys = []
    for n, at in enumerate(combinations(range(7), shared)):
        key = F.lit(n).cast("long")
        for i in at:
            key = F.shiftleft(key, 8).bitwiseOR(byte[i])
        keys.append(key)
    return F.array(*keys)


def _close(a, b, max_bits):
    """Pairs of fingerprints with enough shared positional bytes, verified."""
    x = a ^ b
    shared = (np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8) == 0).sum(1)
    near = shared >= 8 - max_bits
    near[near] = np.bitwise_count(x[near]) <= max_bits
    return near


def _list_links(fp, side, max_bits):
    """Spanning stars of one long list; ``side`` tells two blocks apart."""
    a = b = np.zeros(0, np.int64)
    step = max(1, (1 << 20) // len(fp))
    u = fp.view(np.uint64)
    for i in range(0, len(fp), step):
        rows = np.arange(i, min(i + step, len(fp)))
        x, y = np.nonzero(np.bitwise_count(u[rows][:, None] ^ u[None, i:]) <= max_bits)
        keep = x < y
        x, y = rows[x[keep]], i + y[keep]
        if side is not None:
            cross = side[x] != side[y]
            x, y = x[cross], y[cross]
        near = _close(u[x], u[y], max_bits)
        a, b = forest(np.concatenate([a, fp[x[near]]]), np.concatenate([b, fp[y[near]]]))
    return a, b


def _links(max_bits):
    def complete(key, pair, side, fp):
        if len(fp) == 0:
            return fp, fp
        fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (pair[1:] != pair[:-1])])
        run_id = np.cumsum(fresh) - 1
        start, length = runs(run_id)
        a, b = [fp[:0]], [fp[:0]]
        short = np.repeat(length <= SHORT, length)
        u = fp.view(np.uint64)
        for lag in range(1, int(length[length <= SHORT].max(initial=1))):
            i = np.flatnonzero(short[:-lag] & (run_id[:-lag] == run_id[lag:]))
            i = i[_close(u[i], u[i + lag], max_bits)]
            a.append(fp[i])
            b.append(fp[i + lag])
        for s, n in zip(start[length > SHORT], length[length > SHORT], strict=True):
            x, y = _list_links(fp[s:s + n], side[s:s + n] if pair[s] >= 0 else None, max_bits)
            a.append(x)
            b.append(y)
        return forest(np.concatenate(a), np.concatenate(b))

    def run(batches):
        names = ("key", "pair", "side", "fp")
        carry = {c: np.zeros(0, np.int64) for c in names}
        a = b = np.zeros(0, np.int64)
        for batch in batches:
            got = {c: np.concatenate([carry[c], batch.column(c).to_numpy()]) for c in names}
            # the last list may go on in the next batch
            other = np.flatnonzero((got["key"] != got["key"][-1:]) | (got["pair"] != got["pair"][-1:]))
            cut = other[-1] + 1 if len(other) else 0
            x, y = complete(*(got[c][:cut] for c in names))
            a, b = forest(np.concatenate([a, x]), np.concatenate([b, y]))
            carry = {c: got[c][cut:] for c in names}
        x, y = complete(*carry.values())
        a, b = forest(np.concatenate([a, x]), np.concatenate([b, y]))
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])
    return run


def near_links(fps: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fps(fp)``: spanning stars
    that connect every pair at most ``max_bits`` apart."""
    n = prepared(fps.sparkSession)
    index = fps.select("fp", F.explode(posting_keys(F.col("fp"), max_bits)).alias("key"))
    long_lists = saved(index.groupBy("key").count().filter(F.col("count") > block)
                       .select(F.col("key").alias("k"), F.ceil(F.col("count") / block).cast("long").alias("blocks")))
    dealt = (index.join(sized(long_lists, 32), F.col("key") == F.col("k"), "left")
             .withColumn("side", F.coalesce(F.pmod(F.xxhash64("fp"), F.col("blocks")), F.lit(0)).cast("long"))
             # a block of a long list meets every block, itself included
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("blocks", F.lit(1)) - 1)))
             # pairs of unlike blocks are numbered from 0, a block with itself below
             .select("key", F.when(F.col("side") == F.col("other"), -1 - F.col("side"))
                     .otherwise(F.least("side", "other") * (1 << 20) + F.greatest("side", "other")).alias("pair"),
                     "side", "fp"))
    return (dealt.repartition(n, "key", "pair").sortWithinPartitions("key", "pair")
            .mapInArrow(_links(max_bits), "a long, b long"))


def _classes(docs: DataFrame, words: int, max_bits: int) -> DataFrame:
    """doc_id, fp, mark, component_id and root (the class's smallest
    fingerprint) for every row."""
    prints = saved(fingerprints(docs, words))
    nodes = saved(prints.filter("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    comps = connected_components(near_links(nodes.select("fp"), max_bits))
    rooted = (nodes.join(comps, F.col("fp") == F.col("node"), "left")
              .select("fp", "first_id", F.coalesce("component", "fp").alias("root")))
    # saved, so that either side of the join is a plain shuffle and a large class can be split
    lowest = saved(rooted.groupBy(F.col("root").alias("r")).agg(F.min("first_id").alias("component_id")))
    classes = saved(rooted.join(sized(lowest, 32), F.col("root") == F.col("r"))
                    .select(F.col("fp").alias("c_fp"), "component_id", "root"))
    return (prints.join(sized(classes, 40), F.col("fp") == F.col("c_fp"), "left")
            .select("doc_id", "fp", "mark", "root",
                    F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")))


def near_groups(docs: DataFrame, words: int = WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fp (signed), component_id for every row."""
    return _classes(docs, words, max_bits).select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, words: int = WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each class: of the smallest doc_id, then the smallest
    (signed) fingerprint, then the smallest hash of the text; any one of rows
    alike in doc_id and text.  Rows without doc_id all stay."""
    groups = saved(_classes(docs, words, max_bits).filter("doc_id is not null"))
    pair = F.struct("fp", "mark")
    # rows of a class's doc_id with more than one row there
    again = saved(groups.filter("doc_id = component_id").groupBy(F.col("root").alias("a_root"))
                  .agg(F.count("*").alias("n"), F.min(pair).alias("first")).filter("n > 1"))
    gone = groups.filter(F.col("component_id") < F.col("doc_id")).select("doc_id", "mark")
    if not again.isEmpty():
        gone = gone.unionByName(groups.filter("doc_id = component_id")
                                .join(sized(again, 40), F.col("root") == F.col("a_root"))
                                .filter(pair != F.col("first")).select("doc_id", "mark"))
    drop = saved(gone.select(F.col("doc_id").alias("_gone"), F.col("mark").alias("_text")).distinct())
    rows = boxed(docs).withColumns({"_id": F.col("_row.doc_id").cast("long"),
                                    "_mark": F.xxhash64(empty_if_null("_row.text"))})
    left = rows.join(sized(drop, 24), (F.col("_id") == F.col("_gone")) & (F.col("_mark") == F.col("_text")), "left_anti")
    if again.isEmpty():
        return unboxed(left)
    kept = F.col("_id") == F.col("_again")
    twice = sized(saved(groups.filter("doc_id = component_id").join(sized(again, 40), F.col("root") == F.col("a_root"))
                        .select(F.col("doc_id").alias("_again")).distinct()), 16)
    return unboxed(left.join(twice, kept, "left_anti").unionByName(
        left.join(twice, kept, "left_semi").dropDuplicates(["_id", "_mark"])))


@query("op5_simhash_groups")
def op5_simhash_groups(spark, sf_dir):
    """Every document with its fingerprint and near-duplicate class."""
    return near_groups(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
