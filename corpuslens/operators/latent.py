"""Dense text vectors from a randomised SVD of the TF-IDF matrix (T7, J7).

The encoder is trained on the corpus: A is the documents x terms matrix of
TF-IDF weights, and the vector of a text is the sum of its terms' weights
times their rows of V, the leading right singular vectors (Halko, Martinsson
and Tropp, "Finding structure with randomness", 2011):

1. sketch: Y = A S, where S has random signs, the bits of a hash of the term,
   so S is never stored;
2. power steps sharpen it: Y = A (A' Q), Q an orthonormal basis of Y;
3. B = Q' A is small on one side; the eigenvectors of B B' give V.

A is a table of (key, term, weight) rows.  Rows of one key that follow each
other are packed into one and written once; the most frequent terms are
numbers there.  In a product, the dense rows of frequent terms (a bounded
matrix) are sent to the tasks, or added up there, so no cells are shuffled for
A Z and packed ones for A' Q; cells of rare terms are joined with a table of
``rank + oversample`` columns and summed per key or term.  A basis comes from the columns' inner products: every
partition adds up its own, so the driver sees one matrix of that size
squared, at most 64 x 64.

Terms that all texts have are frequent ones, so no join has hot keys.

Defined results: a text without known terms has no vector; a corpus of lower
rank gives fewer dimensions; the signs of dimensions are arbitrary, cosines
are not; an empty corpus gives an empty encoder.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.operators import vectors
from corpuslens.session import bounded_batches, cut_lineage, release, remove_folder, scratch_dir, ship_package

RANK, OVERSAMPLE, POWER_STEPS = 32, 16, 2
#: a hash has 64 bits, one for each column of the sketch
MOST_COLUMNS = 64
#: directions below this share of the strongest one are noise
FLOOR = 1e-12
#: cells that a worker packs together, and sums that it hands on together
CELLS_AT_ONCE = 100_000
#: a table of dense rows is sent to every task up to this size
SENT_BYTES = 32 << 20


def _names(n: int) -> list[str]:
    return [f"c{j}" for j in range(n)]


def _columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("c") and c[1:].isdigit()]


def _signs(cells: DataFrame, key: str, columns: int) -> DataFrame:
    """Y = A S: (key, c0, ...)."""
    h = F.xxhash64(F.lit("sketch"), "term")
    bit = [1 - 2 * F.call_function("shiftright", h, F.lit(j)).bitwiseAND(F.lit(1)) for j in range(columns)]
    return cells.groupBy(key).agg(*[F.sum(F.col("w") * bit[j]).alias(f"c{j}") for j in range(columns)])


def frequent_terms(cells: DataFrame, most: int = vectors.FREQUENT_WORDS) -> list[str]:
    """The terms of most cells: they are numbered, all others are joined."""
    n = cells.groupBy("term").agg(F.count(F.lit(1)).alias("n")).where("term is not null")
    return n.orderBy(F.desc("n"), "term").limit(most).select("term").toArrow().column(0).to_pylist()


def _packed(cells: DataFrame, keys: Sequence[str], frequent: list[str]) -> DataFrame:
    """(keys, code, w, term, rare): a row for each run of equal keys; frequent
    terms as numbers, rare ones as they are."""
    spark = cells.sparkSession
    bounded_batches(spark)
    sent, n_keys = spark.sparkContext.broadcast(frequent), len(keys)

    def pack(cells, number, more):
        """The packs, and the cells of the last key if more may follow."""
        new = np.zeros(len(cells), bool)
        new[0] = True
        for c in range(n_keys):
            code = cells.column(c).combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
            new[1:] |= code[1:] != code[:-1]
        first = np.flatnonzero(new)
        left = cells.slice(first[-1] if more else len(cells))
        if more:
            cells, new, first = cells.slice(0, first[-1]).combine_chunks(), new[:first[-1]], first[:-1]
        run = np.cumsum(new) - 1
        term = cells.column(n_keys).combine_chunks().dictionary_encode()
        numbers = np.array([number.get(t, -1) for t in term.dictionary.to_pylist()], np.int32)
        code = numbers[term.indices.to_numpy()] if len(numbers) else np.zeros(0, np.int32)
        w, known = cells.column(n_keys + 1).combine_chunks(), code >= 0

        def lists(values, mark):
            ends = np.concatenate([[0], np.cumsum(np.bincount(run[mark], minlength=len(first)))])
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values.filter(pa.array(mark)))

        return pa.RecordBatch.from_arrays(
            [*[cells.column(c).combine_chunks().take(pa.array(first)) for c in range(n_keys)],
             lists(pa.array(code), known), lists(w, known), lists(cells.column(n_keys).combine_chunks(), ~known), lists(w, ~known)],
            [*keys, "code", "w", "term", "rare"]), left

    def run(batches):
        number = {t: i for i, t in enumerate(sent.value)}
        held, rows, goal = [], 0, CELLS_AT_ONCE
        for b in batches:
            held.append(b)
            rows += b.num_rows
            if rows >= goal:
                done, left = pack(pa.Table.from_batches(held).combine_chunks(), number, True)
                if len(done):
                    yield done
                held, rows = left.to_batches(), len(left)
                goal = max(CELLS_AT_ONCE, 2 * rows)
        if rows:
            yield pack(pa.Table.from_batches(held).combine_chunks(), number, False)[0]

    kinds = [f"`{k}` {cells.schema[k].dataType.simpleString()}" for k in keys]
    return (cells.where("term is not null").select(*keys, "term", F.col("w").cast("double").alias("w")).where("w is not null")
            .mapInArrow(run, ", ".join([*kinds, "code array<int>, w array<double>, term array<string>, rare array<double>"])))


def _rare(packs: DataFrame, *carry: str) -> DataFrame:
    cells = packs.where("size(term) > 0").select(*carry, F.explode(F.arrays_zip("term", "rare")).alias("_x"))
    return cells.select(*carry, "_x.term", F.col("_x.rare").alias("w"))


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    n = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    return lists.flatten().to_numpy(zero_copy_only=False), n


def _per_text(packs: DataFrame, keys: Sequence[str], dense: DataFrame, frequent: list[str], together: bool = False) -> DataFrame:
    """A Z: sum of weight times the ``dense`` row of the term, per key.  Texts
    without a term of ``dense`` give no row.  If a text's cells are
    ``together`` in one pack, those without rare terms are not shuffled."""
    spark, names, n_keys = packs.sparkSession, _columns(dense), len(keys)
    order = _numbered(spark, frequent)
    got = dense.join(order, "term").select("code", *names).toArrow()
    matrix, known = np.zeros((len(frequent) + 1, len(names))), np.zeros(len(frequent) + 1, bool)
    at = got.column(0).to_numpy()
    for j in range(len(names)):
        matrix[at, j] = got.column(j + 1).to_numpy()
    known[at] = True
    sent = spark.sparkContext.broadcast((matrix, known))

    def run(batches):
        matrix, known = sent.value
        for b in batches:
            code, n = _flat(b.column(n_keys))
            w, row = b.column(n_keys + 1).flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(n)), n)
            met = known[code]
            code, w, row = code[met], w[met], row[met]
            # without any of them, bincount gives whole numbers
            sums = [pa.array(np.bincount(row, w * matrix[code, j], len(n)).astype(float)) for j in range(len(names))]
            some = pa.array(np.bincount(row, minlength=len(n)) > 0)
            yield pa.RecordBatch.from_arrays([*b.columns[:n_keys], *sums], [*keys, *names]).filter(some)

    kinds = [f"`{k}` {packs.schema[k].dataType.simpleString()}" for k in keys]
    def parts(packs):
        return packs.select(*keys, "code", "w").mapInArrow(run, ", ".join([*kinds, *[f"{c} double" for c in names]]))

    open_ones = packs
    if together:
        # they are read twice
        path = scratch_dir(spark, "open")
        packs.where("size(term) > 0").write.option("compression", "zstd").parquet(path)
        open_ones = spark.read.parquet(path)
    rare = _rare(open_ones, *keys).join(dense, "term").select(*keys, *[(F.col("w") * F.col(c)).alias(c) for c in names])
    added = parts(open_ones).unionByName(rare).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in names])
    return parts(packs.where("size(term) = 0")).unionByName(added) if together else added


def sized(dense: DataFrame, columns: int) -> DataFrame:
    """A written table of dense rows, sent to every task if its counted size allows."""
    return F.broadcast(dense) if dense.count() * 8 * (columns + 3) <= SENT_BYTES else dense


def _numbered(spark, frequent: list[str]) -> DataFrame:
    """(term, code) of the frequent terms, for a broadcast."""
    rows = pa.table({"term": pa.array(frequent, pa.string()), "code": pa.array(range(len(frequent)), pa.int32())})
    return F.broadcast(spark.createDataFrame(rows))


def _per_term(packs: DataFrame, key: str, dense: DataFrame, frequent: list[str]) -> DataFrame:
    """A' Q: sum of weight times the ``dense`` row of the key, per term."""
    spark, names, most = packs.sparkSession, _columns(dense), len(frequent)
    dense = sized(dense, len(names))
    def run(batches):
        total, met = np.zeros((len(names), most)), np.zeros(most, bool)
        for b in batches:
            code, n = _flat(b.column(0))
            w = b.column(1).flatten().to_numpy(zero_copy_only=False)
            used, code = np.unique(code, return_inverse=True)
            met[used] = True
            for j in range(len(names)):
                x = b.column(j + 2).to_numpy(zero_copy_only=False)
                total[j, used] += np.bincount(code, w * np.repeat(x, n), len(used))
        found = np.flatnonzero(met)
        for i in range(0, len(found), CELLS_AT_ONCE):
            some = found[i:i + CELLS_AT_ONCE]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), *[pa.array(x[some]) for x in total]], ["code", *names])

    sums = [F.sum(c).alias(c) for c in names]
    often = (packs.select(key, "code", "w").join(dense, key).select("code", "w", *names).mapInArrow(run, ", ".join(["code int", *[f"{c} double" for c in names]]))
             .groupBy("code").agg(*sums).join(_numbered(spark, frequent), "code").select("term", *names))
    rare = _rare(packs.select(key, "term", "rare").where("size(term) > 0").join(dense, key), *names).groupBy("term").agg(*[F.sum(F.col("w") * F.col(c)).alias(c) for c in names])
    return often.unionByName(rare)


def _inner_products(dense: DataFrame) -> np.ndarray:
    """C' C of the columns C, added up by partition."""
    names = _columns(dense)

    def part(batches):
        total = np.zeros((len(names), len(names)))
        for b in batches:
            x = np.stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(len(names))], 1)
            total += x.T @ x
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()),
                                          pa.array(total.ravel())], ["i", "j", "v"])

    out = np.zeros((len(names), len(names)))
    for i, j, v in dense.select(*names).mapInArrow(part, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v")).collect():
        out[i, j] = v
    return out


def _times(dense: DataFrame, matrix: np.ndarray) -> DataFrame:
    """Every row times a small matrix; other columns stay."""
    names, other = _columns(dense), [c for c in dense.columns if c not in _columns(dense)]
    schema = ", ".join([f"`{c}` {dense.schema[c].dataType.simpleString()}" for c in other]
                       + [f"c{j} double" for j in range(matrix.shape[1])])

    def part(batches):
        for b in batches:
            x = np.stack([b.column(c).to_numpy(zero_copy_only=False) for c in names], 1) @ matrix
            yield pa.RecordBatch.from_arrays([b.column(c) for c in other] + [pa.array(x[:, j]) for j in range(x.shape[1])],
                                             names=other + _names(x.shape[1]))

    return dense.select(*other, *names).mapInArrow(part, schema)


def _spectrum(products: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (largest first) above the floor and their vectors."""
    values, directions = np.linalg.eigh(products)
    keep = np.flatnonzero(values > max(values.max(initial=0.0), 0.0) * FLOOR)[::-1]
    return values[keep], directions[:, keep]


def _orthonormal(dense: DataFrame) -> DataFrame | None:
    """An orthonormal basis of the columns, None if they are all zero.  Two
    passes: the second takes out what rounding left in the first."""
    for _ in range(2):
        values, directions = _spectrum(_inner_products(dense))
        if not len(values):
            return None
        dense = cut_lineage(_times(dense, directions / np.sqrt(values)))
    return dense


def fit(cells: DataFrame, key: str, rank: int = RANK, oversample: int = OVERSAMPLE,
        power_steps: int = POWER_STEPS, frequent: list[str] | None = None) -> tuple[DataFrame, np.ndarray]:
    """Encoder (term, vector array<double>) and singular values of
    ``cells(key, term, w)``, one row per key and term; ``frequent`` terms are
    found if not given."""
    columns = min(rank + oversample, MOST_COLUMNS)
    if not 0 < rank <= columns:
        raise ValueError(f"rank must be in 1..{MOST_COLUMNS}")
    spark = cells.sparkSession
    ship_package(spark)
    cells = cells.select(key, "term", "w").where(F.col("w") != 0)
    frequent = frequent_terms(cells) if frequent is None else frequent
    path = scratch_dir(spark, "packs")
    _packed(cells, [key], frequent).write.option("compression", "zstd").parquet(path)
    packs = spark.read.parquet(path)
    basis = _orthonormal(cut_lineage(_signs(cells, key, columns)))
    release(spark)
    for _ in range(power_steps if basis is not None else 0):
        onto_terms = cut_lineage(_per_term(packs, key, basis, frequent))
        release(spark)
        basis = _orthonormal(cut_lineage(_per_text(packs, [key], onto_terms, frequent)))
        onto_terms = None
        release(spark)
    if basis is None:
        remove_folder(spark, path)
        return spark.createDataFrame([], "term string, vector array<double>"), np.zeros(0)
    projected = cut_lineage(_per_term(packs, key, basis, frequent))
    packs = basis = None
    remove_folder(spark, path)
    release(spark)
    values, directions = _spectrum(_inner_products(projected))
    values, directions = values[:rank], directions[:, :rank]
    right = _times(projected, directions / np.sqrt(values))
    return right.select("term", F.array(*_columns(right)).alias("vector")), np.sqrt(values)


def text_vectors(cells: DataFrame, keys: Sequence[str], encoder: DataFrame, dimensions: int,
                 frequent: list[str] | None = None, together: bool = False) -> DataFrame:
    """(keys, vector) of the texts in ``cells(keys, term, w)``; cells of
    ``frequent`` terms (found if not given) are not shuffled.  ``together``:
    all cells of a text follow each other in one partition."""
    if not dimensions:
        return cells.join(encoder, "term").select(*keys, "vector")
    frequent = frequent_terms(cells) if frequent is None else frequent
    dense = encoder.select("term", *[F.get("vector", F.lit(j)).alias(f"c{j}") for j in range(dimensions)])
    sums = _per_text(_packed(cells, keys, frequent), keys, dense, frequent, together)
    return sums.select(*keys, F.array(*_names(dimensions)).alias("vector"))
