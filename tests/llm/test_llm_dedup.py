"""Exact, SimHash, substring and embedding dedup against brute force."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from llm_fixtures import messy, no_docs  # noqa: F401
from corpuslens.llm import embeddings, exact, simhash, substrings
from corpuslens.llm.components import connected_components
from corpuslens.llm.exact import PatriciaTrie

SPACE = " \t\n\x0b\f\r"


def _components(nodes, links):
    """Smallest reachable node of each, by plain search."""
    near = {n: set() for n in nodes}
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    out = {}
    for n in sorted(nodes):
        if n not in out:
            stack = [n]
            while stack:
                x = stack.pop()
                if x not in out:
                    out[x] = n
                    stack += near[x]
    return out


def test_components_of_paths_stars_and_cliques(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(60)] + [(500, i) for i in range(501, 580)]
    links += [(a, b) for a in range(900, 915) for b in range(900, a)] + [(7, 7), (rng.randrange(60), 540)]
    df = spark.createDataFrame([*links, (None, 3)], "a long, b long").repartition(5)
    got = {r.node: r.component for r in connected_components(df).collect()}
    want = _components({x for e in links for x in e}, links)
    assert got == {k: v for k, v in want.items() if k != v}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_trie_merges_spills_and_keeps_every_string():
    rng = random.Random(1)
    trie, want, spilled = PatriciaTrie(), {}, []
    for i in range(3000):
        body = bytes(rng.choice(b"ab") for _ in range(rng.randrange(12)))
        trie.add(body, (i,))
        want.setdefault(body, []).append(i)
        if trie.held > 40_000:
            spilled += trie.spill()
    got = {}
    for body, owner, count, _ in [*spilled, *trie.terminals(trie.root)]:
        best, n = got.get(body, (owner, 0))
        got[body] = (min(best, owner), n + count)
    assert got == {b: ((ids[0],), len(ids)) for b, ids in want.items()}


def _exact_want(rows):
    groups = {}
    for i, text in rows:
        norm = "".join(c for c in text or "" if c not in SPACE)
        groups.setdefault(norm, []).append((-len(text or ""), i is None, i))
    return {n: (sorted(g, key=lambda x: (x[0], x[1], x[2] or 0))[0][2], len(g)) for n, g in groups.items()}


@pytest.mark.parametrize("budget", [2000, exact.TRIE_BYTES])
def test_exact_groups(spark, messy, budget):
    rows = [(r.doc_id, r.text) for r in messy.collect()]
    want = _exact_want(rows)
    got = exact.exact_groups(messy, budget).collect()
    assert len(got) == len(rows)
    by_sha = {hashlib.sha256(n.encode()).hexdigest(): v for n, v in want.items()}
    for r in got:
        assert (r.keep_id, r.group_size) == by_sha[r.text_sha256]
    kept = [r for r in got if r.kept]
    assert len(kept) == len(want) and len({r.text_sha256 for r in kept}) == len(want)


def test_exact_owner_has_most_code_points(spark):
    df = spark.createDataFrame([(3, "a b"), (2, "ab"), (1, "a  b"), (0, "a  b")], "doc_id long, text string")
    assert {(r.doc_id, r.keep_id, r.kept) for r in exact.exact_groups(df).collect()} == {
        (3, 0, False), (2, 0, False), (1, 0, False), (0, 0, True)}


def test_keep_owners_keeps_all_columns_and_one_of_repeated_rows(messy, no_docs):
    kept = exact.keep_owners(messy)
    assert kept.columns == messy.columns
    rows = kept.collect()
    assert len(rows) == len(_exact_want([(r.doc_id, r.text) for r in messy.collect()]))
    assert sum(r.doc_id == 8 for r in rows) == 1
    assert exact.keep_owners(no_docs).count() == 0 and exact.exact_groups(no_docs).count() == 0


def _fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in SPACE:
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64(x.encode(), seed=42).intdigest() for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_groups(messy, no_docs):
    rows = messy.collect()
    got = simhash.near_groups(messy).collect()
    prints = {r.doc_id: _fingerprint(r.text) for r in rows if r.doc_id is not None}
    links = [(a, b) for a in prints for b in prints if (prints[a] ^ prints[b]).bit_count() <= 4]
    want = _components(prints, links)
    assert len(got) == len(rows)
    for r in got:
        assert r.component_id == (None if r.doc_id is None else want[r.doc_id])
        if r.doc_id is not None:
            assert r.fp & (2 ** 64 - 1) == prints[r.doc_id]
    kept = simhash.keep_first(messy)
    assert kept.columns == messy.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(set(want.values()))
    assert ids.count(None) == sum(r.doc_id is None for r in rows)
    assert simhash.near_groups(no_docs).count() == 0 and simhash.keep_first(no_docs).count() == 0


def test_rows_of_one_doc_id_are_judged_by_their_own_text(spark):
    one, two, three = (" ".join(f"{w}{i}" for i in range(40)) for w in "abc")
    rows = [(1, one), (2, two), (5, one), (5, three), (5, three), (6, two), (7, None), (7, one)]
    for parts in (1, 3):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        # 5 loses its copy of 1 and keeps the text that nobody else has, once
        got = sorted((r.doc_id, r.text) for r in simhash.keep_first(df).collect())
        assert got == [(1, one), (2, two), (5, three)] + [(7, None)]
    # unlike texts of one doc_id in classes of their own, near ones in one class
    near = one + " a40"
    rows = [(3, one), (3, near), (3, two)]
    prints = [_fingerprint(one), _fingerprint(near)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [r.text for r in simhash.keep_first(df).collect()]
    linked = (prints[0] ^ prints[1]).bit_count() <= 4
    first = min((p - (1 << 64) if p >> 63 else p, t) for p, t in zip(prints, (one, near), strict=True))[1]
    assert sorted(kept) == sorted([two, first] if linked else [one, near, two])


def test_fingerprint_in_parts(monkeypatch):
    rng = random.Random(9)
    texts = [" ".join("".join(rng.choice("abC") for _ in range(rng.randrange(1, 5))) for _ in range(n)) + "\n"
             for n in (0, 1, 3, 4, 5, 60, 300)]
    for size in (1 << 22, 17, 3):
        monkeypatch.setattr(simhash, "PART_BYTES", size)
        assert [simhash.fingerprint(t.encode()) for t in texts] == [_fingerprint(t) for t in texts]


@pytest.mark.parametrize("block", [8, 4096])
def test_simhash_links_near_and_long_lists(spark, block):
    rng = random.Random(5)
    prints = {rng.getrandbits(64) for _ in range(150)}
    centre = rng.getrandbits(64)
    for _ in range(150):
        flips = sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 4)))
        prints |= {centre ^ flips, rng.choice(sorted(prints)) ^ flips}
    prints = sorted(x - (1 << 64) if x >> 63 else x for x in prints)
    links = [(a, b) for a in prints for b in prints
             if a < b and ((a ^ b) & (2 ** 64 - 1)).bit_count() <= 4]
    df = spark.createDataFrame([(x,) for x in prints], "fp long")
    got = {r.node: r.component for r in connected_components(simhash.near_links(df, block=block)).collect()}
    want = _components(prints, links)
    assert got == {k: v for k, v in want.items() if k != v}


def _without_repeats(rows, span=50):
    first, out = {}, {}
    for i, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        body = (text or "").encode()
        covered = np.zeros(len(body), bool)
        for k in range(len(body) - span + 1):
            if first.setdefault(body[k:k + span], i) < i:
                covered[k:k + span] = True
        edges = np.diff(np.concatenate([[0], covered.astype(int), [0]]))
        out[i] = (len(body), int(covered.sum()), int((edges == 1).sum()),
                  bytes(np.frombuffer(body, np.uint8)[~covered]))
    return out


def _texts(rng, n):
    base = ["".join(rng.choice("abcdé ") for _ in range(rng.randrange(30, 400))) for _ in range(12)]
    out = []
    for i in range(n):
        parts = [rng.choice(base) for _ in range(rng.randrange(3))]
        text = "".join(p[rng.randrange(10):len(p) - rng.randrange(10)] for p in parts)
        if text and rng.random() < 0.5:
            k = rng.randrange(len(text))
            text = text[:k] + "X" + text[k + 1:]
        out.append((i, text + "ab" * rng.randrange(80)))
    return out


@pytest.mark.parametrize(("chunk", "hot"), [(1 << 21, 1 << 14), (700, 1)])
def test_substring_dedup(spark, monkeypatch, chunk, hot):
    rows = [*_texts(random.Random(7), 60), (100, None), (101, ""), (None, "q" * 80), (102, "q" * 80), (103, "q" * 49)]
    monkeypatch.setattr(substrings, "CHUNK", chunk)
    monkeypatch.setattr(substrings, "HOT_BLOCKS", hot)
    want = _without_repeats(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for r in substrings.without_repeats(df).collect():
        if r.doc_id is None:
            assert r.n_removed == 0 and bytes(r.kept) == b"q" * 80
        else:
            assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) == want[r.doc_id], r.doc_id


def test_substring_dedup_of_a_messy_and_an_empty_table(messy, no_docs):
    out = {r.doc_id: r for r in substrings.without_repeats(messy).collect()}
    assert out[6].n_removed == len(out[6].kept) + out[6].n_bytes - 2 * len(out[6].kept)
    assert bytes(out[6].kept) == b"end" and out[5].n_removed == 0
    assert substrings.without_repeats(no_docs).count() == 0


def test_hot_windows_are_combined_and_sorted_in_chunks(monkeypatch):
    monkeypatch.setattr(substrings, "SORTED", 64)
    rng = random.Random(5)
    same = bytes(rng.choice(b"abcdef") for _ in range(52))
    ids = rng.sample(range(5000), 2000)
    asked = [{"kind": 3, "at": 4, "size": 52, "route": 1}]
    batches = [pa.RecordBatch.from_pylist([{"doc_id": i, "body": b"%04d" % i + same, "asked": asked}
                                           for i in ids[k:k + 100]]) for k in range(0, 2000, 100)]
    cut = list(substrings._cut_blocks(50)(batches))
    rows = [r for b in cut for r in b.to_pylist()]
    sent = [r for r in rows if r["body"] is not None]
    assert len(sent) == 3 and {r["doc_id"] for r in sent} == {min(ids)}
    spans = {(r["doc_id"], r["at"], r["size"]) for r in rows if r["body"] is None}
    assert {d for d, _, _ in spans} == set(ids) - {min(ids)}
    # rows of one route from many tasks
    held = []
    inner = substrings.repeated
    monkeypatch.setattr(substrings, "repeated", lambda doc, blocks, span: held.append(len(blocks)) or inner(doc, blocks, span))
    route = [substrings._cut([7] * 100, ids[k:k + 100], [3] * 100, [50] * 100, [same[:50]] * 100)
             for k in range(0, 2000, 100)]
    found = [r for b in substrings._sorted_suffixes(50)(route) for r in b.to_pylist()]
    assert sorted(r["doc_id"] for r in found) == sorted(set(ids) - {min(ids)})
    assert all((r["at"], r["size"]) == (3, 50) for r in found) and max(held) <= 300


def test_deep_shallow_orders_suffixes():
    rng = random.Random(2)
    text = bytes(rng.choice(b"ab") for _ in range(300)) * 3 + bytes(rng.choice(b"abc") for _ in range(400))
    suffixes = np.arange(len(text) - 49)
    groups = list(substrings.deep_shallow(text, suffixes, 50))
    order = [text[g[0]:g[0] + 50] for g in groups]
    assert order == sorted(order) and len(set(order)) == len(order)
    assert sorted(i for g in groups for i in g) == suffixes.tolist()
    assert all(len({text[i:i + 50] for i in g}) == 1 for g in groups)


def _vector_want(rows, cosine=0.9):
    ok = []
    for i, v in rows:
        good = i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        ok.append(np.pad(np.array(v, float), (0, 16 - len(v))) if good else None)
    links = {}
    for a, x in enumerate(ok):
        for b, y in enumerate(ok):
            if a < b and x is not None and y is not None and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= cosine:
                links.setdefault(a, []).append(b)
                links.setdefault(b, []).append(a)
    return links


@pytest.mark.parametrize("block", [7, 4096])
def test_near_vectors(spark, block):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(25, 16))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 25] + rng.normal(size=16) * (0.22 if i % 3 else 0.02)])
            for i in range(200)]
    rows += [(200, rows[0][1]), (201, rows[0][1]), (202, None), (203, []), (204, [0.0] * 16),
             (205, [float("nan")] * 16), (206, [None] + [1.0] * 15), (207, [float("inf")] + [1.0] * 15),
             (None, rows[0][1]), (208, rows[3][1][:9])]
    links = _vector_want(rows)
    ids = [r[0] for r in rows]
    comp = _components([i for i in ids if i is not None],
                       [(ids[a], ids[b]) for a, bs in links.items() for b in bs])
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, node string, own int")
    got = embeddings.near_vectors(df, block=block).collect()
    assert len(got) == len(rows)
    found = sum(r.n_links for r in got)
    assert found >= 0.99 * sum(map(len, links.values()))
    for r in got:
        k = ids.index(r.vec_id)
        assert r.n_links <= len(links.get(k, []))
        assert r.component_id == comp.get(r.vec_id) and r.kept == (r.vec_id == r.component_id or r.vec_id is None)
    assert embeddings.near_vectors(df.limit(0)).count() == 0


@pytest.mark.parametrize("kind", ["axis", "lines"])
@pytest.mark.parametrize("probed, recall", [(50, 1.0), (600, 0.99), (4096, 1.0)])
def test_near_vectors_that_differ_in_few_directions(spark, monkeypatch, kind, probed, recall):
    monkeypatch.setattr(embeddings, "PROBED", probed)
    rng = np.random.default_rng(1)
    if kind == "axis":
        x = rng.normal(size=(1000, 64))
        x /= np.linalg.norm(x, axis=1)[:, None]
        step = rng.choice([-1, 1], 1000) * rng.uniform(0.3, 0.42, 1000)
        x = np.concatenate([x, x + step[:, None] * np.eye(64)[0]])
    else:
        start, way = rng.normal(size=(2, 20, 64))
        x = start[np.arange(2000) % 20] + way[np.arange(2000) % 20] * rng.uniform(-1, 1, 2000)[:, None]
    x /= np.linalg.norm(x, axis=1)[:, None]
    want = (x @ x.T >= 0.9).sum(1) - 1
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = np.zeros(len(x), int)
    for r in embeddings.near_vectors(df).collect():
        found[r.vec_id] = r.n_links
    assert (found <= want).all() and found.sum() >= recall * want.sum()


def test_rare_links_are_found_without_visiting_all_cells(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "PROBED", 200)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(60, 32))
    x = centres[rng.integers(0, 60, 4000)] + rng.normal(size=(4000, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    for k in range(0, 120, 2):  # 60 links, most vectors have none
        way = rng.normal(size=32)
        way -= way @ x[k] * x[k]
        c = rng.uniform(0.901, 0.97)
        x[k + 1] = c * x[k] + np.sqrt(1 - c * c) * way / np.linalg.norm(way)
    want = (x @ x.T >= 0.9).sum(1) - 1
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    nodes = df.select(F.col("vec_id").alias("node"), F.lit(1).cast("long").alias("copies"), "embedding")
    q = embeddings.fitted(nodes, 4000, 32, 0.9)
    reach = embeddings.sufficient_reach(nodes, q, 4000, 0.9)
    assert q.reach <= reach < q.bound
    found = {r.vec_id: r.n_links for r in embeddings.near_vectors(df).collect()}
    assert all(found[i] <= want[i] for i in range(4000)) and 0 < want.sum() < 400
    assert sum(found.values()) >= 0.95 * want.sum()


def test_candidate_pairs_are_compared_in_bounded_steps(spark, monkeypatch):
    rng = np.random.default_rng(6)
    x = rng.normal(size=16) + rng.normal(size=(300, 16)) * 0.05
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    want = embeddings.near_vectors(df).collect()
    monkeypatch.setattr(embeddings, "HELD", 64)
    assert sorted(embeddings.near_vectors(df).collect()) == sorted(want)
    assert all(r.n_links == 299 for r in want)
