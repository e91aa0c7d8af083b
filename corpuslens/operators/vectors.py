"""Sentence/document vectors and cosine similarity.

Default encoder: sparse TF-IDF rows ``(keys, term, weight)`` with
weight = tf * (ln((1 + N) / (1 + df)) + 1).  A dense encoder can be plugged
in as a pandas UDF returning ``array<float>``; ``dense_cosine`` then works on
the arrays with higher-order functions (no Python).

Scale: the only term-keyed join is (document, term) rows against the
document-frequency table.  Common terms are hot keys there; see
``idf_table`` for how that join is kept divisible.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslens.functions import segment
from corpuslens.functions import wordruns as W
from corpuslens.session import bounded_batches, cut_lineage, ship_package


def term_counts(rows: DataFrame, keys: Sequence[str], text_col: str) -> DataFrame:
    """(keys, term, tf) from the words of ``text_col``."""
    ex = rows.select(*keys, F.explode(segment.words(text_col)).alias("term"))
    return ex.groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("tf"))


def idf_table(docs: DataFrame, key: str, text_col: str) -> DataFrame:
    """(term, idf) over the documents, written to the shared folder once.

    Counts combine map-side, so a term of every document costs one row per
    task.  Because the table is a plain scan afterwards, a join of (document,
    term) rows with it has a bare shuffle on either side, and AQE can divide
    the partition of a term that most documents have.
    """
    n_docs = docs.select(F.count(F.lit(1))).scalar()
    df = document_frequencies(docs, text_col).groupBy("term").agg(F.sum("n").alias("doc_freq"))
    idf = F.ln((F.lit(1.0) + n_docs.cast("double")) / (F.lit(1.0) + F.col("doc_freq").cast("double"))) + F.lit(1.0)
    return cut_lineage(df.select("term", idf.alias("idf")))


#: rows of counts that a worker holds before they are added up
COUNTS_HELD = 1 << 19


def document_frequencies(docs: DataFrame, text_col: str) -> DataFrame:
    """(term, n): in how many of some rows a term occurs; a term's ``n`` add
    up to that of all rows."""
    bounded_batches(docs.sparkSession)

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            text = batch.column(0)
            for i, j in W.blocks(pc.utf8_length(text).to_numpy().astype(np.int64)):
                found, n, _ = W.words(*W.code_points(text.slice(i, j - i)), W.latin())
                code, terms = W.numbered(found)
                _, term = W.parts(W.counted(W.joined(np.repeat(np.arange(j - i), n), code))[0])
                held.append(pa.table([terms.cast(pa.string()), pa.array(np.bincount(term, minlength=len(terms)))], ["term", "n"]))
                rows += len(terms)
                if rows > COUNTS_HELD:
                    held = [_added_up(held)]
                    rows = len(held[0])
                    if rows > COUNTS_HELD // 2:
                        yield from held[0].to_batches(10_000)
                        held, rows = [], 0
        if rows:
            yield from _added_up(held).to_batches(10_000)

    return docs.select(F.lower(F.coalesce(F.col(text_col), F.lit(""))).alias("_t")).mapInArrow(run, "term string, n bigint")


def _added_up(held: list[pa.Table]) -> pa.Table:
    sums = pa.concat_tables(held).group_by("term", use_threads=False).aggregate([("n", "sum")])
    return pa.table([sums.column("term"), sums.column("n_sum")], ["term", "n"]).combine_chunks()


def distinct_terms(docs: DataFrame, key: str, text_col: str, without=None) -> DataFrame:
    """(key, term), one row for each term of a document that isn't found in
    ``without`` (a broadcast of ``SentWeights``)."""
    bounded_batches(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            words = W.distinct(batch.column(1))
            row = np.repeat(np.arange(len(words)), pc.list_value_length(words).to_numpy(zero_copy_only=False))
            found = pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), words.flatten()], [key, "term"])
            if without is not None:
                code, terms = W.numbered(found.column(1))
                found = found.filter(pa.array(~without.value.find(_numbers(terms, without.value.seed))[0][code]))
            yield found

    return (docs.select(key, F.lower(F.coalesce(F.col(text_col), F.lit(""))).alias("_t"))
            .mapInArrow(run, f"`{key}` {kind}, term string"))


def row_counts(rows: DataFrame, keys: Sequence[str], text_col: str, sent=None) -> DataFrame:
    """(keys, term, tf) of every row by itself, without a shuffle; rows with
    the same keys are not added up.  A row's terms follow each other.  With
    ``sent`` (a broadcast of ``SentWeights``) there is also their idf."""
    bounded_batches(rows.sparkSession)
    names = [*keys, "term", "tf"] + ["idf"] * (sent is not None)
    kinds = [f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys]

    def run(batches):
        for batch in batches:
            text = batch.column(len(keys))
            for i, j in W.blocks(pc.utf8_length(text).to_numpy().astype(np.int64)):
                found, n, _ = W.words(*W.code_points(text.slice(i, j - i)), W.latin())
                code, terms = W.numbered(found)
                v = max(len(terms), 1)
                pair, tf = np.unique(np.repeat(np.arange(j - i), n) * v + code, return_counts=True)
                row, term = np.divmod(pair, v)
                idf = [] if sent is None else [pa.array(sent.value.find(_numbers(terms, sent.value.seed))[1][term])]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).take(pa.array(row + i)) for c in range(len(keys))],
                     terms.take(pa.array(term)).cast(pa.string()), pa.array(tf.astype(np.int64)), *idf], names)

    return (rows.select(*keys, F.lower(F.coalesce(F.col(text_col), F.lit(""))).alias("_t"))
            .mapInArrow(run, ", ".join([*kinds, "term string", "tf bigint", *["idf double"] * (sent is not None)])))


def by_rows(docs: DataFrame, key: str) -> tuple[DataFrame, DataFrame | None]:
    """The rows whose key no other row has, and all others (None: there are none)."""
    often = cut_lineage(docs.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_k"))
    if often.isEmpty():
        return docs, None
    same = F.col(key).eqNullSafe(F.col("_k"))
    return docs.join(often, same, "left_anti"), docs.join(often, same, "left_semi")


def document_counts(docs: DataFrame, key: str, text_col: str) -> DataFrame:
    """(key, term, tf) of every document.  Only documents of several rows
    are added up by a shuffle."""
    once, several = by_rows(docs, key)
    if several is None:
        return row_counts(once, [key], text_col)
    return row_counts(once, [key], text_col).unionByName(_added_counts(several, key, text_col))


def _added_counts(docs: DataFrame, key: str, text_col: str) -> DataFrame:
    return row_counts(docs, [key], text_col).groupBy(key, "term").agg(F.sum("tf").alias("tf"))


def document_weights(docs: DataFrame, key: str, text_col: str, idf: DataFrame, sent, every: bool) -> DataFrame:
    """(key, term, tf, idf) of every document.  If ``sent_idf`` knows the
    weights of all terms, they are looked up where the terms are counted."""
    if not every:
        return with_idf(document_counts(docs, key, text_col), idf)
    once, several = by_rows(docs, key)
    found = row_counts(once, [key], text_col, sent)
    return found if several is None else found.unionByName(with_idf(_added_counts(several, key, text_col), idf))


#: terms that may be sent to every task: as numbers of ten bytes, as words
FREQUENT, FREQUENT_WORDS = 1 << 23, 1 << 18


def with_idf(counts: DataFrame, idf: DataFrame) -> DataFrame:
    """``counts`` with the idf of their terms: the most frequent terms (lowest
    idf) are sent to the tasks, so only rows of the rare ones are shuffled."""
    most = min(FREQUENT, FREQUENT_WORDS)
    if idf.count() <= most:
        return counts.join(F.broadcast(idf), "term")
    often = F.broadcast(cut_lineage(idf.orderBy("idf", "term").limit(most)))
    rare = counts.join(often.select("term"), "term", "left_anti").join(idf, "term")
    return counts.join(often, "term").unionByName(rare)


class SentWeights(NamedTuple):
    """The idf of terms, found by their numbers."""
    seed: int
    keys: np.ndarray  # numbers of terms, ascending
    level: np.ndarray  # which of ``values`` is a term's
    values: np.ndarray
    rest: float  # the idf of all other terms

    def find(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether terms are listed, and their idf (``rest`` if not)."""
        if not len(self.keys):
            return np.zeros(len(numbers), bool), np.full(len(numbers), self.rest)
        # looked up in order, so that neighbours share what is in the cache
        order = np.argsort(numbers)
        at = np.empty(len(numbers), np.int64)
        at[order] = np.minimum(np.searchsorted(self.keys, numbers[order]), len(self.keys) - 1)
        hit = self.keys[at] == numbers
        return hit, np.where(hit, self.values[self.level[at]], self.rest)


def _numbers(terms: pa.Array, seed: int) -> np.ndarray:
    return W.word_numbers(*W.code_points(terms), W.latin(), seed)[0]


#: sets of letter numbers that are tried
SEEDS = 8


def sent_idf(idf: DataFrame):
    """Weights of the most frequent terms as a broadcast, and whether these
    and one idf for the rest are the weights of all terms.

    Terms are sent as 64-bit numbers.  Whether these tell all terms of the
    table apart is counted; if not, other letter numbers are taken.
    """
    bounded_batches(idf.sparkSession)

    def numbered(seed):
        def run(batches):
            for b in batches:
                yield pa.RecordBatch.from_arrays([pa.array(_numbers(b.column(0), seed)), b.column(1)], ["number", "idf"])
        return idf.select("term", "idf").mapInArrow(run, "number bigint, idf double")

    # one row for each document frequency
    sizes = idf.groupBy("idf").agg(F.count(F.lit(1)).alias("n")).orderBy("idf").toArrow()
    levels, n = (sizes.column(c).to_numpy() for c in ("idf", "n"))
    for seed in range(SEEDS):
        if numbered(seed).select(F.count_distinct("number")).first()[0] == n.sum():
            break
    else:
        raise RuntimeError(f"{SEEDS} sets of letter numbers don't tell the terms apart")
    whole = int(np.searchsorted(np.cumsum(n), FREQUENT, "right"))
    every = whole + 1 >= len(levels)
    rest = float(levels[whole]) if every and whole < len(levels) else 0.0
    numbers, values = np.zeros(0, np.int64), np.zeros(0)
    if whole:
        rows = numbered(seed).where(F.col("idf") <= float(levels[whole - 1])).toArrow()
        numbers, values = (rows.column(c).to_numpy() for c in ("number", "idf"))
    order = np.argsort(numbers)
    level = np.searchsorted(levels, values[order]).astype(np.min_scalar_type(max(len(levels), 1)))
    return idf.sparkSession.sparkContext.broadcast(SentWeights(seed, numbers[order], level, levels, rest)), every


def dense_cosine(a, b) -> Column:
    """Cosine of two equal-length numeric arrays, as doubles; null on zero norm."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    ad = F.transform(a, lambda x: x.cast("double"))
    bd = F.transform(b, lambda x: x.cast("double"))
    dot = F.aggregate(F.zip_with(ad, bd, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    na = F.sqrt(F.aggregate(ad, F.lit(0.0), lambda s, x: s + x * x))
    nb = F.sqrt(F.aggregate(bd, F.lit(0.0), lambda s, x: s + x * x))
    return F.try_divide(dot, na * nb)


def pandas_encoder(fn: Callable, dim: int | None = None):
    """Wrap ``fn(list[str]) -> list[list[float]]`` as an Arrow-batched UDF.

    The model is created lazily inside ``fn`` on each executor; Spark sends
    text in Arrow batches, never row by row.
    """
    from pyspark.sql import SparkSession

    active = SparkSession.getActiveSession()
    if active is not None:
        ship_package(active)

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def encode(texts: pd.Series) -> pd.Series:
        return pd.Series(list(fn(texts.fillna("").tolist())))

    return encode


def _component_sums(batches):
    """Sums and counts of every component, by group, of one partition."""
    sums, counts, kind = {}, {}, None
    for b in batches:
        kind = b.schema.field(0).type
        group, lists = b.column(0).dictionary_encode(), b.column(1)
        values = lists.flatten()
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
        width = int(sizes.max(initial=0))
        if not width:
            continue
        code = pc.fill_null(group.indices, len(group.dictionary)).to_numpy()
        place = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        at = np.repeat(code, sizes).astype(np.int64) * width + place
        known = pc.is_valid(values).to_numpy(zero_copy_only=False)
        shape = (len(group.dictionary) + 1, width)
        added = np.bincount(at[known], values.drop_null().to_numpy().astype(float), shape[0] * width).reshape(shape)
        seen = np.bincount(at[known], minlength=shape[0] * width).reshape(shape)
        longest = np.zeros(shape[0], np.int64)
        np.maximum.at(longest, code, sizes)
        for i in np.flatnonzero(longest):
            name = group.dictionary[int(i)].as_py() if i < len(group.dictionary) else None
            old, n = sums.get(name, np.zeros(0)), counts.get(name, np.zeros(0, np.int64))
            size = longest[i]
            more = max(0, size - len(old))
            old, n = np.pad(old, (0, more)), np.pad(n, (0, more))
            old[:size] += added[i, :size]
            n[:size] += seen[i, :size]
            sums[name], counts[name] = old, n
    if sums:
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), kind), pa.array(list(sums.values()), pa.list_(pa.float64())),
                                          pa.array(list(counts.values()), pa.list_(pa.int64()))], ["g", "s", "n"])


def group_centroids(vectors: DataFrame, group_col: str, vec_col: str) -> DataFrame:
    """(group, centroid array<double>): the mean vector of every group.

    Every partition adds up its vectors and hands on one row per group, so
    what is exchanged does not depend on the number of vectors; components
    are added by index, then put together (a group is one vector's length).
    """
    ship_package(vectors.sparkSession)
    kind = vectors.schema[group_col].dataType.simpleString()
    parts = (vectors.select(group_col, F.col(vec_col).cast("array<double>").alias("_v"))
             .mapInArrow(_component_sums, f"g {kind}, s array<double>, n array<bigint>"))
    comp = parts.select(F.col("g").alias(group_col), F.posexplode(F.arrays_zip("s", "n")).alias("i", "c"))
    means = comp.groupBy(group_col, "i").agg(F.try_divide(F.sum("c.s"), F.sum("c.n")).alias("m"))
    return means.groupBy(group_col).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s.getField("m")).alias("centroid"))
