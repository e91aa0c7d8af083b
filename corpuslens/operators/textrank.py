"""TextRank candidate selection as Spark joins (Mihalcea & Tarau 2004).

Definition used here (replaces a POS-tagging library, same purpose: cap the
sentences that reach the vector ranking):

* words: lower-cased runs of >= 3 letters, minus the caller's stop-word table
  if one is given (a published list; it is inlined as one array);
* graph per document: undirected edges between words at most ``lookback``
  positions apart in the filtered word sequence, weight = co-occurrence
  count, self-edges dropped;
* PageRank: r0 = 1/n, r = (1 - d)/n + d * sum(p * r), fixed iterations;
* sentence score = sum of the ranks of its distinct words;
* the ``limit`` best sentences by (score rounded to 9 digits desc, pos asc)
  are kept; documents with at most ``limit`` sentences keep all of them,
  so the graph is only built for long documents.

Two executions of the same definition:

* ``cooccurrence_edges`` + ``word_pagerank``: edges as rows and PageRank of
  any edge table, in one row per graph where its edges lie together, else as
  unrolled join/aggregate iterations.
* ``doc_word_ranks``: each document's graph is independent and bounded by
  the document's length, so the graph is built and iterated inside one row
  (numpy); no shuffle at all.  The extraction job uses the same kernel.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.functions import wordruns
from corpuslens.options import CANDIDATE_LIMIT
from corpuslens.session import bounded_batches, cut_lineage, scratch_dir

# Algorithm parameters.
LEAST_LETTERS = 3
TEXTRANK_WORD_PATTERN = rf"\p{{L}}{{{LEAST_LETTERS},}}"
DAMPING = 0.85
ITERATIONS = 10
LOOKBACK = 3
SCORE_DIGITS = 9

#: words of documents and edges that a worker holds together
WORDS_AT_ONCE, EDGES_AT_ONCE = 100_000, 100_000
#: edges of a graph that may be one row
EDGES_PER_ROW = 200_000


def textrank_words(col) -> F.Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(TEXTRANK_WORD_PATTERN), 0)


def _filtered_words(rows: DataFrame, keys: list[str], text_col: str, stop: DataFrame | None) -> DataFrame:
    """(keys, words): textrank words of ``text_col`` without stop words.

    Subqueries cannot sit inside a lambda, hence the ``_stop`` column.
    """
    if stop is None:
        return rows.select(*keys, textrank_words(text_col).alias("words"))
    listed = stop.select(F.collect_list("word")).scalar()
    with_stop = rows.select(*keys, textrank_words(text_col).alias("_w"), listed.alias("_stop"))
    return with_stop.select(*keys, F.filter("_w", lambda x: ~F.array_contains(F.col("_stop"), x)).alias("words"))


def _row_edges(lookback: int):
    """Arrow function: (key, words) rows -> the edges of every row."""
    def run(batches):
        for batch in batches:
            keys, lists = batch.column(0), batch.column(1)
            n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            for i, j in wordruns.blocks(n, WORDS_AT_ONCE):
                coded = lists.slice(i, j - i).flatten().dictionary_encode()
                code, row = coded.indices.to_numpy().astype(np.int64), np.repeat(np.arange(j - i), n[i:j])
                v = max(len(coded.dictionary), 1)
                near = []
                for d in range(1, lookback + 1):
                    a, b, of = code[:-d], code[d:], row[d:]
                    keep = (a != b) & (row[:-d] == of)
                    near += [(of[keep] * v + a[keep]) * v + b[keep], (of[keep] * v + b[keep]) * v + a[keep]]
                edge, weight = np.unique(np.concatenate(near), return_counts=True)
                edge, b = np.divmod(edge, v)
                of, a = np.divmod(edge, v)
                for at in range(0, len(of), EDGES_AT_ONCE):
                    part = slice(at, at + EDGES_AT_ONCE)
                    yield pa.RecordBatch.from_arrays(
                        [keys.slice(i, j - i).take(pa.array(of[part])), coded.dictionary.take(pa.array(a[part])),
                         coded.dictionary.take(pa.array(b[part])), pa.array(weight[part].astype(np.int64))],
                        [batch.schema.field(0).name, "a", "b", "weight"])
    return run


def cooccurrence_edges(docs: DataFrame, key: str, text_col: str, stop: DataFrame | None = None,
                       lookback: int = LOOKBACK) -> DataFrame:
    """(key, a, b, weight): both directions of every undirected edge.

    A document's edges are counted in its row and not shuffled.  Only where
    several rows have one key are their counts added up.
    """
    bounded_batches(docs.sparkSession)
    often = cut_lineage(docs.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_k"))
    fw = _filtered_words(docs, [key], text_col, stop)
    kind = fw.schema[key].dataType.simpleString()

    def edges(rows):
        return rows.select(key, "words").mapInArrow(_row_edges(lookback), f"`{key}` {kind}, a string, b string, weight bigint")

    if often.isEmpty():
        return edges(fw)
    same = F.col(key).eqNullSafe(F.col("_k"))
    added = edges(fw.join(often, same, "left_semi")).groupBy(key, "a", "b").agg(F.sum("weight").alias("weight"))
    return edges(fw.join(often, same, "left_anti")).unionByName(added)


def _pack(edges: pa.Table) -> pa.RecordBatch:
    """Edges of some graphs in a row -> one row a run of equal keys."""
    key = edges.column(0).combine_chunks()
    code = key.dictionary_encode(null_encoding="encode").indices.to_numpy()
    first = np.concatenate([[0], np.flatnonzero(code[1:] != code[:-1]) + 1])
    run = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(code))))
    sides = pa.concat_arrays([edges.column(c).combine_chunks() for c in (1, 2)])
    words = sides.dictionary_encode(null_encoding="encode")
    v = len(words.dictionary)
    node, at = np.unique(np.tile(run, 2) * v + words.indices.to_numpy(), return_inverse=True)
    of, n = node // v, len(run)
    start = np.searchsorted(of, np.arange(len(first) + 1))
    local = (at - np.tile(start[run], 2)).astype(np.int32)
    met = np.zeros((2, len(node)), bool)
    met[0, at[:n]], met[1, at[n:]] = True, True
    weight = edges.column(3).combine_chunks()
    known = pc.is_valid(sides).to_numpy(zero_copy_only=False)
    wrong = ~(known[:n] & known[n:] & pc.is_valid(key).to_numpy(zero_copy_only=False)
              & pc.fill_null(pc.greater(weight, 0.0), False).to_numpy(zero_copy_only=False))
    even = (np.bincount(of, ~met.all(0), len(first)) + np.bincount(run, wrong, len(first))) == 0
    stops = pa.array(np.append(first, n), pa.int32())
    lists = [pa.ListArray.from_arrays(pa.array(start, pa.int32()), words.dictionary.take(pa.array(node % v))),
             *[pa.ListArray.from_arrays(stops, x) for x in (pa.array(local[:n]), pa.array(local[n:]), weight)]]
    return pa.RecordBatch.from_arrays([key.take(pa.array(first)), *lists, pa.array(even)],
                                      [edges.column_names[0], "words", "a", "b", "weight", "even"])


def _packs(batches):
    """Arrow function: edge rows -> graphs, as far as their edges lie in a row."""
    held, goal = [], EDGES_AT_ONCE
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < goal:
            continue
        edges = pa.Table.from_batches(held).combine_chunks()
        code = edges.column(0).combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
        last = int(np.max(np.flatnonzero(code[1:] != code[:-1]), initial=-1)) + 1
        if len(code) - last >= EDGES_PER_ROW:
            last = len(code)
        if last:
            yield _pack(edges.slice(0, last))
        held = edges.slice(last).to_batches()
        goal = max(EDGES_AT_ONCE, 2 * (len(code) - last))
    if sum(b.num_rows for b in held):
        yield _pack(pa.Table.from_batches(held).combine_chunks())


def _unpacked_edges(packs: DataFrame, key: str) -> DataFrame:
    e = packs.select(key, "words", F.explode(F.arrays_zip("a", "b", "weight")).alias("e"))
    return e.select(key, F.get("words", F.col("e.a")).alias("a"), F.get("words", F.col("e.b")).alias("b"), "e.weight")


def _pack_ranks(iterations: int, damping: float):
    """Arrow function: whole graphs -> (key, word, rank), some at a time."""
    def run(batches):
        for batch in batches:
            sizes = pc.list_value_length(batch.column("a")).to_numpy().astype(np.int64)
            for i, j in wordruns.blocks(sizes, EDGES_AT_ONCE):
                part = batch.slice(i, j - i)
                n = pc.list_value_length(part.column("words")).to_numpy().astype(np.int64)
                before = np.repeat(np.cumsum(n) - n, sizes[i:j])
                a, b = (part.column(c).flatten().to_numpy() + before for c in ("a", "b"))
                weight = part.column("weight").flatten().to_numpy().astype(float)
                nodes, total = np.repeat(n, n).astype(float), int(n.sum())
                p = weight / np.bincount(a, weight, total)[a]
                r = 1.0 / nodes
                for _ in range(iterations):
                    r = (1.0 - damping) / nodes + damping * np.bincount(b, p * r[a], total)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(np.repeat(np.arange(j - i), n))), part.column("words").flatten(),
                     pa.array(r)], [batch.schema.field(0).name, "word", "rank"])
    return run


def word_pagerank(edges: DataFrame, key: str, iterations: int = ITERATIONS,
                  damping: float = DAMPING) -> DataFrame:
    """(key, word, rank) after a fixed number of power iterations per graph.

    Edges of one key that follow each other are packed into one row (words
    once, edges as numbers) and written once.  A graph that is one such row is
    iterated there.  Graphs in several rows (too large for one, or with edges
    scattered over the table) and those with one-way words or odd weights are
    iterated by joins.
    """
    spark = edges.sparkSession
    bounded_batches(spark)
    kinds = {c: edges.schema[c].dataType.simpleString() for c in (key, "weight")}
    path = scratch_dir(spark, "graphs")
    edges.select(key, "a", "b", "weight").mapInArrow(
        _packs, f"`{key}` {kinds[key]}, words array<string>, a array<int>, b array<int>, "
        f"weight array<{kinds['weight']}>, even boolean").write.option("compression", "zstd").parquet(path)
    packs = spark.read.parquet(path)
    other = cut_lineage(packs.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"), F.min("even").alias("_even"))
                        .where("_n > 1 or not _even").select("_k"))

    def in_rows(rows):
        return rows.select(key, "words", "a", "b", "weight").mapInArrow(
            _pack_ranks(iterations, damping), f"`{key}` {kinds[key]}, word string, rank double")

    if other.isEmpty():
        return in_rows(packs)
    same = F.col(key).eqNullSafe(F.col("_k"))
    joined = _joined_pagerank(_unpacked_edges(packs.join(other, same, "left_semi"), key), key, iterations, damping)
    return in_rows(packs.join(other, same, "left_anti")).unionByName(joined)


def _joined_pagerank(edges: DataFrame, key: str, iterations: int, damping: float) -> DataFrame:
    """``word_pagerank`` of any edge table, an aggregation per iteration."""
    out_w = edges.groupBy(key, "a").agg(F.sum("weight").alias("out_w"))
    trans = (edges.join(out_w, [key, "a"])
             .select(key, "a", "b", (F.col("weight") / F.col("out_w")).alias("p")))
    n = out_w.groupBy(key).agg(F.count(F.lit(1)).cast("double").alias("n"))
    # cut the lineage once: every iteration re-reads the transition table
    trans = cut_lineage(trans)
    n = cut_lineage(n)
    ranks = out_w.select(key, F.col("a").alias("word")).join(n, key) \
        .select(key, "word", (F.lit(1.0) / F.col("n")).alias("r"))
    for _ in range(iterations):
        contrib = (trans.join(ranks.withColumnRenamed("word", "a"), [key, "a"])
                   .groupBy(key, "b").agg(F.sum(F.col("p") * F.col("r")).alias("s")))
        ranks = contrib.join(n, key).select(
            key, F.col("b").alias("word"),
            (F.lit(1.0 - damping) / F.col("n") + F.lit(damping) * F.col("s")).alias("r"))
    return ranks.withColumnRenamed("r", "rank")


def _ranks(node: np.ndarray, doc: np.ndarray, lookback: int, iterations: int, damping: float) -> tuple[np.ndarray, np.ndarray]:
    """PageRank of the co-occurrence graphs of some documents whose words
    follow each other: which words have edges, and the ranks of all.

    ``node`` numbers the words from 0, those of each document by themselves;
    ``doc`` is a word's document.  An edge weighs as often as its words stand
    near each other, so a word's sum over its edges is one over the places
    beside its own, and no table of edges is made.
    """
    v = int(node.max(initial=-1)) + 1
    near = [((node[d:] != node[:-d]) & (doc[d:] == doc[:-d])).astype(float) for d in range(1, lookback + 1)]

    def beside(x):
        out = np.zeros(len(node))
        for d, m in enumerate(near, 1):
            out[d:] += m * x[:-d]
            out[:-d] += m * x[d:]
        return out

    weight = np.bincount(node, beside(np.ones(len(node))), v)
    met = weight > 0
    of = np.zeros(v, np.int64)
    of[node] = doc
    n = np.maximum(np.bincount(of[met], minlength=int(of.max(initial=-1)) + 1)[of], 1).astype(float)
    r = met / n
    start = met * (1.0 - damping) / n
    share = np.divide(1.0, weight, out=np.zeros(v), where=met)
    for _ in range(iterations):
        r = start + damping * np.bincount(node, beside((r * share)[node]), v)
    return met, r


def _graph_ranks(words, lookback: int, iterations: int, damping: float):
    """PageRank of one document's co-occurrence graph: (words, ranks)."""
    if len(words) < 2:
        return [], []
    code, names = wordruns.numbered(pa.array(words, pa.string()))
    met, r = _ranks(code, np.zeros(len(code), np.int64), lookback, iterations, damping)
    return names.filter(pa.array(met)).to_pylist(), r[met].tolist()


def _row_ranks(lookback: int, iterations: int, damping: float):
    """Arrow function: (key, words) rows -> (key, word, rank), some documents
    at a time."""
    def run(batches):
        for batch in batches:
            keys, lists = batch.column(0), batch.column(1)
            n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            for i, j in wordruns.blocks(n, WORDS_AT_ONCE):
                code, names = wordruns.numbered(lists.slice(i, j - i).flatten())
                doc = np.repeat(np.arange(j - i), n[i:j])
                node, pairs = wordruns.numbered(pa.array(wordruns.joined(doc, code)))
                met, r = _ranks(node, doc, lookback, iterations, damping)
                of, word = wordruns.parts(pairs.to_numpy()[met])
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(i, j - i).take(pa.array(of)), names.take(pa.array(word)), pa.array(r[met])],
                    [batch.schema.field(0).name, "word", "rank"])
    return run


def doc_word_ranks(docs: DataFrame, key: str, text_col: str, stop: DataFrame | None = None,
                   lookback: int = LOOKBACK, iterations: int = ITERATIONS,
                   damping: float = DAMPING) -> DataFrame:
    """(key, word, rank) computed per document row, without any shuffle."""
    bounded_batches(docs.sparkSession)
    fw = _filtered_words(docs, [key], text_col, stop)
    key_type = fw.schema[key].dataType.simpleString()

    return fw.mapInArrow(_row_ranks(lookback, iterations, damping), f"`{key}` {key_type}, word string, rank double")


def kept_positions(codes: np.ndarray, sizes: np.ndarray, docs: np.ndarray, limit: int, lookback: int = LOOKBACK,
                   iterations: int = ITERATIONS, damping: float = DAMPING) -> tuple[np.ndarray, np.ndarray]:
    """1-based positions of the ``limit`` best sentences of each document, in
    order, and how many each document has.

    ``codes`` number the words of all sentences in a row, ``sizes`` is how
    many of them each sentence has, ``docs`` how many sentences a document."""
    doc = np.repeat(np.arange(len(docs)), docs)
    at = np.repeat(np.arange(len(sizes)), sizes)
    node, _ = wordruns.numbered(pa.array(wordruns.joined(doc[at], codes)))
    _, rank = _ranks(node, doc[at], lookback, iterations, damping)
    sent, word = wordruns.parts(wordruns.counted(wordruns.joined(at, node))[0])
    score = np.round(np.bincount(sent, rank[word], len(sizes)), SCORE_DIGITS)
    order = np.lexsort((-score, doc))  # stable: equal scores stay in order
    first = np.cumsum(docs) - docs
    kept = np.sort(order[np.arange(len(order)) - first[doc] < limit])
    return kept - first[doc[kept]] + 1, np.minimum(docs, limit)
