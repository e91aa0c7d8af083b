"""Summaries that begin with the shorter ones are counted once."""

import random

import pyarrow as pa

from corpuslens.functions import wordruns as W
from corpuslens.operators import overlap

LISTED = type("Listed", (), {"value": {"a", "zwei"}})


def test_texts_that_go_on_are_read_once(spark, monkeypatch):
    seen = []
    words = W.words
    monkeypatch.setattr(W, "words", lambda points, *rest: seen.append(len(points)) or words(points, *rest))
    lines = [f"line {i} of a text, zwei wörter." for i in range(40)]
    texts = ["\n".join(lines[:n]) for n in (10, 20, 30, 40)]
    got = overlap.pair_counts((1, 2), LISTED).func(pa.array(texts), pa.array(["line 3 of a"] * 4)).to_pylist()
    assert sum(seen) <= len(texts[-1]) + 20
    assert [r["n_words"] for r in got] == [6 * n for n in (10, 20, 30, 40)]
    assert [r["missing"] for r in got] == [4 * n for n in (10, 20, 30, 40)]
    assert [r["n_sents"] for r in got] == [10, 20, 30, 40] and {tuple(r["matched"]) for r in got} == {(3, 2)}


def test_chains_count_like_single_rows(spark, monkeypatch):
    count = overlap.pair_counts((1, 2, 3, 4), LISTED).func
    random.seed(7)
    pieces = ["a b a", "a", "", " ", "é zwei. a", "a b! \n b", "...", "漢字 a😀b", "b a b a b"]
    rows = [("a b", "a b"), ("a b\na b", "a b"), ("a bc", "a b"), ("a b", "x"), ("a b\nc", "x"), ("", "a"), ("\na", "a"), ("\na", "a"),
            ("a", "a"), (None, "a"), (None, None), ("a", None), ("a\nb", None)]
    for _ in range(40):
        text, ref = random.choice(pieces), "\n".join(random.choices(pieces, k=2))
        for _ in range(random.randrange(1, 6)):
            rows.append((text, ref))
            text += random.choice(["\n", "\n", " ", "\n\n"]) + random.choice(pieces)
    gen, ref = (pa.array([r[i] for r in rows], pa.string()) for i in (0, 1))
    alone = [count(gen.slice(i, 1), ref.slice(i, 1)).to_pylist()[0] for i in range(len(rows))]
    for block in (W.BLOCK, 30):
        monkeypatch.setattr(W, "BLOCK", block)
        assert count(gen, ref).to_pylist() == alone
    assert count(gen.slice(0, 0), ref.slice(0, 0)).to_pylist() == []
