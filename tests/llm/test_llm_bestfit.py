import zlib

import numpy as np
import pytest

from llm_fixtures import messy, no_docs  # noqa: F401

from corpuslens.llm import bestfit, packing
from corpuslens.llm.common import table

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("capacity", [1, 7, 64, 2048])
def test_best_fit_decreasing_equals_a_plain_search(capacity):
    sizes = np.random.default_rng(capacity).integers(1, capacity + 1, 2000)
    window, offset, room = bestfit.best_fit_decreasing(sizes, capacity)
    rooms = []
    for size in sorted(sizes.tolist(), reverse=True):
        fitting = [r for r in rooms if r >= size]
        if fitting:
            rooms.remove(min(fitting))
        rooms.append((min(fitting) if fitting else capacity) - size)
    assert sorted(rooms) == sorted(room.tolist())
    assert np.array_equal(np.bincount(window, sizes), capacity - room)
    order = np.lexsort([offset, window])
    for w in range(len(room)):
        mine = order[window[order] == w]
        assert np.array_equal(offset[mine], np.cumsum(sizes[mine]) - sizes[mine])


def _check_windows(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return len(by)


def test_pieces_are_those_of_the_whole_text(spark):
    import public_tokenizers
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    rows = bestfit.op13_best_fit_decreasing(spark, SF).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    docs = table(spark, SF, "documents").select("doc_id", "text").collect()
    assert len(by) == len(docs)
    for d in docs:
        ids = tok.encode(d.text or "", add_special_tokens=False).ids + [bestfit.END_ID]
        at = 0
        for r in sorted(by[d.doc_id], key=lambda r: r.start):
            part = np.array(ids[at:at + r.length], "<u4").tobytes()
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(part))
            at += r.length
        assert at == len(ids)
    n = _check_windows(rows, 2048)
    assert n <= -(-sum(r.length for r in rows) // 2048) + 1


def test_groups_meet_again_until_little_is_padded(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(i, 0, int(n), 0, int(n)) for i, n in enumerate(rng.integers(1, 100, 3000))]
    pieces = spark.createDataFrame(rows, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long").repartition(5)
    monkeypatch.setattr(bestfit, "GROUP", 256)
    got = bestfit.pack_pieces(pieces, 100, slack=1).collect()
    assert sorted((r.doc_id, r.length) for r in got) == sorted((r[0], r[2]) for r in rows)
    alone = len(bestfit.best_fit_decreasing(np.array([r[2] for r in rows]), 100)[2])
    assert _check_windows(got, 100) <= 1.03 * alone


def test_messy_rows_are_packed(messy, no_docs):
    got = bestfit.pack(messy, capacity=64).collect()
    _check_windows(got, 64)
    assert sum(r.length for r in got if r.start == 0 and r.doc_tokens == 1) == messy.filter(
        "text is null or trim(translate(text, '\t\n', '  ')) = ''").count()
    firsts = [r.doc_id for r in got if r.start == 0]
    assert sorted(firsts, key=repr) == sorted((r.doc_id for r in messy.collect()), key=repr)
    assert bestfit.pack(no_docs).collect() == []
