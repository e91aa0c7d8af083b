"""Embedding near-dedup with product quantisation.

Unit vectors are assigned to coarse cells (inverted lists); their residuals
are coded per subspace.  A query visits every cell that a vector within the
distance bound may lie in, and in it sums, over the subspaces, table entries
of its own residual (asymmetric distance).  A code's quantisation error is
stored, and by the triangle inequality a vector whose table distance exceeds
the bound plus its error is out for certain; the others are compared exactly,
by cosine in double precision.

Sufficient probes: a cell is visited if the bisector between it and the
vector's own cell is within reach.  At a reach of the distance bound t no pair
is lost, but in many dimensions that is nearly every cell.  Pairs that differ
alike in all directions need about t / sqrt(d), d being the effective
dimension of the data (participation ratio of the covariance), others more; so
``PROBED`` vectors (by hash order) are compared with all rows, and the reach is
the largest that any of their links needs, at least ``PROBE_SD`` such steps.
If fewer than ``LINKED`` of them have links and there are more rows, links are
planted: each of ``PLANTED`` vectors is moved by the whole bound t towards its
nearest other vector, and away from it, and the reach covers these pairs too.
So few links make it wider, never all cells.  For pairs of two cells the vector in the cell with the smaller number
probes; the pair counts for both.

Quantisers are fitted on at most ``TRAIN`` vectors (by hash order); all
vectors are indexed.  Equal vectors are one entry.  A long list is cut into
blocks, and its queries go to each.  Tasks return counts and spanning stars
of their links, never the links of a group.

Defined results: vectors that are null, empty, zero, or hold null or
non-finite components link with nothing, nor do rows without vec_id; shorter
vectors count as padded with zeros; repeated rows are copies and link with
each other; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.common import forest, prepared, query, saved, sized, table
from corpuslens.llm.components import connected_components

COSINE = 0.9
TRAIN, SEED = 16384, 11
SUB_DIM, CODES = 4, 256
PROBE_SD = 3.0
#: vectors that are compared with all rows, and how many with links tell the reach
PROBED, LINKED = 4096, 300
#: vectors whose nearest one gives directions where links are rare
PLANTED = 1024
#: numbers of a work array: rows by cells, or candidate pairs by dimensions
HELD = 1 << 22
#: vectors of an inverted list that one task holds at once
BLOCK = 4096
CHUNK = 512

_ROW = "cell int, block int, kind int, node long, copies long, own int, err double, code binary, vec binary"


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column as doubles, padded with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    size = np.diff(column.offsets.to_numpy())
    if len(size) and (size == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(size), dim))
    at = np.cumsum(size) - size
    for i, (a, n) in enumerate(zip(at, size, strict=True)):
        out[i, :n] = flat[a:a + n]
    return out


def _unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _square(x, c):
    """Squared distances of all rows of x to all rows of c."""
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1), 0)


def _kmeans(x, k, rng, rounds=8):
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = _square(x, c).argmin(1)
        n = np.bincount(near, minlength=len(c))
        for j in range(x.shape[1]):
            c[:, j] = np.where(n > 0, np.bincount(near, x[:, j], len(c)) / np.maximum(n, 1), c[:, j])
    return c


class Quantiser:
    """Coarse cells and residual codebooks, with the reach of a probe."""

    def __init__(self, x: np.ndarray, cells: int, cosine: float):
        rng = np.random.default_rng(SEED)
        self.dim = x.shape[1]
        self.bound = np.sqrt(2 - 2 * cosine)
        self.cells = _kmeans(x, cells, rng)
        rest = self.padded(x - self.cells[_square(x, self.cells).argmin(1)])
        self.books = [_kmeans(rest[:, j:j + SUB_DIM], CODES, rng) for j in range(0, rest.shape[1], SUB_DIM)]
        spread = np.linalg.eigvalsh(np.cov(x.T) if len(x) > 1 else np.eye(self.dim))
        effective = max(spread.sum() ** 2 / max((spread ** 2).sum(), 1e-300), 1.0)
        self.reach = PROBE_SD * self.bound / np.sqrt(effective)

    @staticmethod
    def padded(x):
        return np.pad(x, ((0, 0), (0, -x.shape[1] % SUB_DIM)))

    def encode(self, x):
        """Cell, codes and quantisation error of every unit vector."""
        d = _square(x, self.cells)
        own = d.argmin(1)
        rest = self.padded(x - self.cells[own])
        codes, err = np.empty((len(x), len(self.books)), np.uint8), np.zeros(len(x))
        for m, book in enumerate(self.books):
            s = _square(rest[:, m * SUB_DIM:(m + 1) * SUB_DIM], book)
            codes[:, m] = s.argmin(1)
            err += s.min(1)
        # half the distance surplus over the distance of the cells: how far the bisector is
        home, at = np.unique(own, return_inverse=True)
        apart = np.sqrt(_square(self.cells[home], self.cells))
        with np.errstate(divide="ignore", invalid="ignore"):
            away = (d - d[np.arange(len(x)), own][:, None]) / (2 * apart[at])
        away[np.arange(len(x)), own] = 0
        away = np.where(np.isnan(away), 0, away)
        probes = (away <= self.reach) & (np.arange(len(self.cells)) >= own[:, None])
        return own, codes, np.sqrt(err), probes

    def needed(self, x, y, own_x, own_y):
        """Reach at which the pairs of rows of x and y are found."""
        first = own_x <= own_y
        low, high = np.where(first, own_x, own_y), np.where(first, own_y, own_x)
        v = np.where(first[:, None], x, y)
        far, near = (((v - self.cells[c]) ** 2).sum(1) for c in (high, low))
        apart = np.sqrt(((self.cells[low] - self.cells[high]) ** 2).sum(1))
        return np.where(apart > 0, (far - near) / (2 * np.maximum(apart, 1e-300)), 0)

    def table_distances(self, x, cell, codes):
        """Squared distance of every unit vector to every coded one."""
        rest = self.padded(x - self.cells[cell]).astype(np.float32)
        total = np.zeros((len(x), len(codes)), np.float32)
        for m, book in enumerate(self.books):
            t = _square(rest[:, m * SUB_DIM:(m + 1) * SUB_DIM], book.astype(np.float32))
            total += np.take(t, codes[:, m], axis=1)
        return total


def _assign(shared):
    def run(batches):
        q = shared.value
        for b in batches:
            x = _unit(_matrix(b.column("embedding"), q.dim))
            step = max(1, HELD // len(q.cells))
            for i in range(0, len(x), step):
                own = _square(x[i:i + step], q.cells).argmin(1)
                yield pa.RecordBatch.from_pydict({"cell": pa.array(own.astype(np.int32))})
    return run


def _needs(shared, ids, s, cosine):
    """Per batch and probed vector that has links in it, the reach they need."""
    def run(batches):
        q = shared.value
        own_s = _square(s, q.cells).argmin(1)
        for b in batches:
            x = _unit(_matrix(b.column("embedding"), q.dim))
            own_x, node = _square(x, q.cells).argmin(1), b.column("node").to_numpy()
            i, j = np.nonzero((x @ s.T >= cosine) & (node[:, None] != ids))
            most = np.full(len(s), -1.0)
            most[j] = 0
            differ = own_x[i] != own_s[j]
            i, j = i[differ], j[differ]
            for a in range(0, len(i), 1 << 14):
                k, m = i[a:a + (1 << 14)], j[a:a + (1 << 14)]
                np.maximum.at(most, m, q.needed(x[k], s[m], own_x[k], own_s[m]))
            found = np.flatnonzero(most >= 0)
            yield pa.RecordBatch.from_pydict({"probed": pa.array(found.astype(np.int32)), "reach": pa.array(most[found])})
    return run


def _nearest(shared, ids, s):
    """Per task and vector of ``s``, the nearest other vector and its cosine."""
    def run(batches):
        q = shared.value
        best, who = np.full(len(s), -2.0), np.zeros((len(s), q.dim))
        for b in batches:
            x = _unit(_matrix(b.column("embedding"), q.dim))
            node = b.column("node").to_numpy()
            for a in range(0, len(x), max(1, HELD // len(s))):
                part = slice(a, a + max(1, HELD // len(s)))
                near = np.where(node[part][:, None] == ids, -2.0, x[part] @ s.T)
                at = near.argmax(0)
                value = near[at, np.arange(len(s))]
                better = np.flatnonzero(value > best)
                best[better], who[better] = value[better], x[part][at[better]]
        found = np.flatnonzero(best > -2)
        yield pa.RecordBatch.from_pydict({
            "probed": pa.array(found.astype(np.int32)), "near": pa.array(best[found]),
            "vec": pa.array([v.tobytes() for v in who[found]], pa.binary())})
    return run


def planted_reach(nodes: DataFrame, shared, ids: np.ndarray, s: np.ndarray, cosine: float) -> float:
    """Reach that finds vectors at just ``cosine`` from those of ``s``, towards
    and away from the nearest other vector of each."""
    q = shared.value
    rows = (nodes.select("node", "embedding").mapInArrow(_nearest(shared, ids, s), "probed int, near double, vec binary")
            .groupBy("probed").agg(F.max_by("vec", "near").alias("vec")).collect())
    if not rows:
        return 0.0
    v = s[[r[0] for r in rows]]
    u = np.array([np.frombuffer(r[1]) for r in rows])
    way = u - (u * v).sum(1)[:, None] * v
    size = np.linalg.norm(way, axis=1)
    v, way = v[size > 1e-9], way[size > 1e-9] / size[size > 1e-9][:, None]
    most = 0.0
    for sign in (1, -1):
        y = cosine * v + sign * np.sqrt(1 - cosine * cosine) * way
        for a in range(0, len(v), max(1, HELD // len(q.cells))):
            part = slice(a, a + max(1, HELD // len(q.cells)))
            own_v, own_y = (_square(z[part], q.cells).argmin(1) for z in (v, y))
            differ = own_v != own_y
            need = q.needed(v[part][differ], y[part][differ], own_v[differ], own_y[differ])
            most = max(most, need.max(initial=0.0))
    return most


def sufficient_reach(nodes: DataFrame, q: Quantiser, n: int, cosine: float) -> float:
    """Reach that finds all links of ``PROBED`` vectors with all rows, and
    planted ones where there are few."""
    some = nodes.select("node", "embedding").orderBy(F.xxhash64("node", F.lit(1)), "node").limit(PROBED).toArrow()
    s = _unit(_matrix(some.column("embedding"), q.dim))
    shared = nodes.sparkSession.sparkContext.broadcast(q)
    ids = some.column("node").to_numpy()
    needs = nodes.select("node", "embedding").mapInArrow(_needs(shared, ids, s, cosine), "probed int, reach double")
    linked, reach = needs.agg(F.count_distinct("probed"), F.coalesce(F.max("reach"), F.lit(0.0))).first()
    if linked < LINKED and n > PROBED:
        few = nodes.select("node", "embedding").orderBy(F.xxhash64("node", F.lit(1)), "node").limit(PLANTED).toArrow()
        reach = max(reach, planted_reach(nodes, shared, few.column("node").to_numpy(),
                                         _unit(_matrix(few.column("embedding"), q.dim)), cosine))
    # not to miss a pair at the reach itself by rounding; beyond the bound there is none
    return min(max(q.reach, reach * (1 + 1e-6) + 1e-9), q.bound * (1 + 1e-6))


def _deal(shared, blocks):
    """Entries to their list's block, queries to every block they probe."""
    def run(batches):
        q = shared.value
        of = np.array([blocks.get(c, 1) for c in range(len(q.cells))])
        for b in batches:
            raw = _matrix(b.column("embedding"), q.dim)
            node, copies = b.column("node").to_numpy(), b.column("copies").to_numpy()
            step = max(1, min(2048, HELD // len(q.cells)))
            for i in range(0, len(raw), step):
                part = slice(i, i + step)
                x, ids, n = raw[part], node[part], copies[part]
                own, codes, err, probes = q.encode(_unit(x))
                vecs = [v.tobytes() for v in x]
                who, cell = np.nonzero(probes)
                # one query for each block of the cell
                times = of[cell]
                who, cell = np.repeat(who, times), np.repeat(cell, times)
                block = np.arange(len(who)) - np.repeat(np.cumsum(times) - times, times)
                home = (ids * 2654435761 >> 7) % of[own]
                yield _rows(own, home, 0, ids, n, own, err, [c.tobytes() for c in codes], vecs)
                for j in range(0, len(who), 4096):
                    w = who[j:j + 4096]
                    yield _rows(cell[j:j + 4096], block[j:j + 4096], 1, ids[w], n[w], own[w], np.zeros(len(w)),
                                [None] * len(w), [vecs[k] for k in w])
    return run


def _rows(cell, block, kind, node, copies, own, err, code, vec):
    return pa.RecordBatch.from_pydict({
        "cell": pa.array(cell.astype(np.int32)), "block": pa.array(block.astype(np.int32)),
        "kind": pa.array(np.full(len(cell), kind, np.int32)), "node": pa.array(node), "copies": pa.array(copies),
        "own": pa.array(own.astype(np.int32)), "err": pa.array(err), "code": pa.array(code, pa.binary()),
        "vec": pa.array(vec, pa.binary())})


def _search(shared, cosine):
    """Rows sorted by (cell, block, kind): a block's entries, then its queries."""
    def run(batches):
        q = shared.value
        at, entries, queries = None, [], []
        held = None

        def close():
            """Entries of the block as arrays, once its first query comes."""
            ids, n, err, code, vec = (list(x) for x in zip(*entries, strict=True))
            raw = np.frombuffer(b"".join(vec)).reshape(len(ids), -1)
            return (np.array(ids), np.array(n), np.array(err, np.float32), _unit(raw),
                    np.frombuffer(b"".join(code), np.uint8).reshape(len(ids), -1))

        def found():
            ids, n, err, unit, codes = held
            q_ids, q_n, q_own, vec = (list(x) for x in zip(*queries, strict=True))
            q_ids, q_n, q_own = np.array(q_ids), np.array(q_n), np.array(q_own)
            x = _unit(np.frombuffer(b"".join(vec)).reshape(len(q_ids), -1))
            d = q.table_distances(x, at[0], codes)
            i, j = np.nonzero(d <= (q.bound + err + 1e-3) ** 2)
            differ = q_ids[i] != ids[j]
            i, j = i[differ], j[differ]
            step = max(1, HELD // x.shape[1])
            near = np.concatenate([np.zeros(0, bool)] + [
                np.einsum("ij,ij->i", x[i[a:a + step]], unit[j[a:a + step]]) >= cosine for a in range(0, len(i), step)])
            i, j = i[near], j[near]
            out = [(q_ids, np.bincount(i, n[j], len(q_ids)))]
            # the entry's side of a pair of two cells is counted here as well
            other = q_own[i] != at[0]
            out.append((ids, np.bincount(j[other], q_n[i[other]], len(ids))))
            a, b = forest(q_ids[i], ids[j])
            who = np.concatenate([k[c > 0] for k, c in out] + [a])
            links = np.concatenate([c[c > 0] for _, c in out] + [np.zeros(len(a))]).astype(np.int64)
            to = np.concatenate([np.full(len(who) - len(a), -1), b])
            return pa.RecordBatch.from_pydict({
                "a": pa.array(who), "b": pa.array(to.astype(np.int64), mask=np.arange(len(who)) < len(who) - len(a)),
                "links": pa.array(links)})

        for batch in batches:
            for cell, block, kind, node, copies, own, err, code, vec in zip(
                    *(c.to_pylist() for c in batch.columns), strict=True):
                if (cell, block) != at:
                    if queries and held is not None:
                        yield found()
                    at, entries, queries, held = (cell, block), [], [], None
                if kind == 0:
                    entries.append((node, copies, err, code, vec))
                elif entries:
                    held = held or close()
                    queries.append((node, copies, own, vec))
                    if len(queries) == CHUNK:
                        yield found()
                        queries = []
        if queries and held is not None:
            yield found()
    return run


def valid(name: str = "embedding"):
    x = F.col(name)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce((F.size(x) > 0) & finite & F.exists(x, lambda v: v != 0), F.lit(False))


def fitted(nodes: DataFrame, n: int, dim: int, cosine: float, train: int = TRAIN) -> Quantiser:
    rows = nodes.select("embedding").orderBy(F.xxhash64("node"), "node").limit(train).toArrow()
    x = _unit(_matrix(rows.column("embedding"), dim))
    return Quantiser(x, max(1, round(np.sqrt(n))), cosine)


def link_counts(nodes: DataFrame, cosine: float = COSINE, train: int = TRAIN, block: int = BLOCK) -> DataFrame:
    """(a, b, links): links found for node a where b is null, else spanning
    links a-b.  ``nodes(node, copies, embedding)`` holds distinct vectors."""
    spark = nodes.sparkSession
    parts = prepared(spark)
    n, dim = nodes.agg(F.count("*"), F.max(F.size("embedding"))).first()
    if not n:
        return spark.createDataFrame([], "a long, b long, links long")
    q = fitted(nodes, n, dim, cosine, train)
    q.reach = sufficient_reach(nodes, q, n, cosine)
    shared = spark.sparkContext.broadcast(q)
    # as many rows as there are cells
    sizes = nodes.select("embedding").mapInArrow(_assign(shared), "cell int").groupBy("cell").count().collect()
    blocks = {r[0]: -(-r[1] // block) for r in sizes}
    dealt = nodes.select("node", "copies", "embedding").mapInArrow(_deal(shared, blocks), _ROW)
    return (dealt.repartition(parts, "cell", "block").sortWithinPartitions("cell", "block", "kind")
            .mapInArrow(_search(shared, cosine), "a long, b long, links long"))


def near_vectors(vectors: DataFrame, cosine: float = COSINE, train: int = TRAIN, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding",
                          (valid() & F.col("vec_id").isNotNull()).alias("ok"))
    nodes = saved(rows.filter("ok").groupBy("embedding").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies")))
    # a vec_id that two different vectors share still is one node
    found = saved(link_counts(nodes, cosine, train, block))
    counts = found.filter("b is null").groupBy(F.col("a").alias("c_node")).agg(F.sum("links").alias("links"))
    comps = connected_components(found.filter("b is not null").select("a", "b"))
    state = saved(counts.join(comps, F.col("c_node") == F.col("node"), "left")
                  .select("c_node", "links", F.coalesce("component", "c_node").alias("component")))
    copied = saved(nodes.filter("copies > 1").select(F.col("embedding").alias("e"), "node", "copies"))
    bytes_each = 64 + 8 * (copied.agg(F.max(F.size("e"))).first()[0] or 0)
    with_node = rows.join(sized(copied, bytes_each), F.col("ok") & (F.col("embedding") == F.col("e")), "left").select(
        "vec_id", F.coalesce("node", "vec_id").alias("own"), F.when(F.col("ok"), F.coalesce("copies", F.lit(1)))
        .otherwise(1).alias("copies"), "ok")
    return (with_node.join(sized(state, 48), F.col("ok") & (F.col("own") == F.col("c_node")), "left")
            .select("vec_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"),
                    F.coalesce("component", "own").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))


@query("op1_pq_near_vectors")
def op1_pq_near_vectors(spark, sf_dir):
    """Every vector with its links and class at cosine 0.9."""
    return near_vectors(table(spark, sf_dir, "embeddings"))
