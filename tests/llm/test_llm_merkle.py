import hashlib
import zlib

import pytest
from llm_fixtures import messy, no_docs  # noqa: F401
from oracle_compare import compare

from corpuslens.llm import merkle

SF = "/root/testdata/sf0.001"


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(r, text):
    parts = [r["doc_id"], r["source"], r["lang"], r["n_chars"], text]
    return _h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in parts])


def _up(nodes):
    """Top of the nodes, and each one's (left, right) siblings by level."""
    paths, below = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, under = [], []
        for i in range(0, len(nodes), 3):
            run = nodes[i:i + 3]
            for k in range(len(run)):
                for leaf in below[i + k]:
                    paths[leaf].append((run[:k], run[k + 1:]))
            above.append(_h(*run))
            under.append(sum(below[i:i + 3], []))
        nodes, below = above, under
    return nodes[0], paths


def brute(rows):
    by = {}
    for r in rows:
        by.setdefault(r["source"], []).append((r, _leaf(r, r["text"])))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    tops = []
    for s in sources:
        by[s].sort(key=lambda x: (x[0]["doc_id"] is not None, x[0]["doc_id"] or 0, x[1]))
        tops.append(_up([leaf for _, leaf in by[s]]))
    root, across = _up([top for top, _ in tops])
    out = []
    for s, (top, paths), rest in zip(sources, tops, across):
        for (r, leaf), path in zip(by[s], paths):
            text, path = r["text"], path + rest
            if None not in (text, r["doc_id"]) and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            node = _leaf(r, text)
            for left, right in path:
                node = _h(*left, node, *right)
            out.append((r["doc_id"], leaf, top, root, _h(*[d for left, right in path for d in left + right]),
                        node, node == root))
    return sorted(out, key=repr)


def _query(docs):
    rows = merkle.verify(merkle.manifest(docs), "probe")
    return sorted((tuple(r) for r in rows.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(merkle.F.col("path")), "folded_root", "verified").collect()), key=repr)


def test_sql_agrees(spark):
    assert not compare(spark, merkle.op12_merkle_manifest, merkle.OP12_SQL, SF)


@pytest.mark.parametrize("depth", [1, 2, 6])
def test_blocks_of_any_depth_give_the_same_tree(spark, monkeypatch, depth):
    monkeypatch.setattr(merkle, "DEPTH", depth)
    docs = spark.createDataFrame(
        [(i, f"text\n{i}" if i % 3 else None, "en", None if i % 7 == 0 else ("hot" if i < 60 else f"s{i}"), i) for i in range(100)],
        "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    assert _query(docs) == brute([r.asDict() for r in docs.collect()])


def test_messy_rows(messy, no_docs):
    assert _query(messy) == brute([r.asDict() for r in messy.collect()])
    assert _query(no_docs) == []
    # a lone leaf is its subroot and the root, with an empty proof
    one = messy.filter("doc_id = 7")
    got = _query(one)
    assert got == brute([r.asDict() for r in one.collect()]) and got[0][1] == got[0][3]
