"""Packing, mixing, chat, sharding, language ID, toxicity and the pipeline."""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm_fixtures import messy, no_docs  # noqa: F401
from corpuslens.llm import chat, entry, langid, mixing, packing, sharding, toxicity
from oracle_compare import compare

SMALL_SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, key):
    assert not compare(spark, entry.queries()[key], entry.oracle_sql()[key], SMALL_SF)


def _best_fit(lengths, capacity):
    import bisect
    gaps, n = [], 0
    for size in sorted(lengths, reverse=True):
        i = bisect.bisect_left(gaps, size)
        gap = gaps.pop(i) if i < len(gaps) else capacity
        n += gap == capacity
        bisect.insort(gaps, gap - size)
    return n


def _packed_well(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_pack_ids_and_places(spark, messy, no_docs):
    from tokenizers import Tokenizer
    import public_tokenizers
    tok = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    want = []
    for r in messy.collect():
        ids = np.array(tok.encode(r.text or "", add_special_tokens=False).ids + [0], "<u4")
        want += [(r.doc_id, k, a, len(ids[a:a + 2048]), zlib.crc32(ids[a:a + 2048].tobytes()))
                 for k, a in enumerate(range(0, len(ids), 2048))]
    rows = packing.pack(messy).collect()
    key = lambda t: (t[0] is None, t[0] or 0, *t[1:])
    assert sorted((tuple(r)[:5] for r in rows), key=key) == sorted(want, key=key)
    n = _packed_well(rows, 2048)
    assert n <= _best_fit([w[3] for w in want], 2048) + 1
    whole = packing.sequences(messy.dropDuplicates(["doc_id"]), packing.pack(messy.dropDuplicates(["doc_id"])))
    assert sum(len(r.ids) for r in whole.collect()) // 4 == sum(
        len(tok.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in messy.dropDuplicates(["doc_id"]).collect())
    assert packing.pack(no_docs).count() == 0


@pytest.mark.parametrize("kind", ["tiny", "mixed", "equal"])
def test_packing_is_near_best_fit(spark, kind):
    rng = np.random.default_rng(1)
    sizes = {"tiny": rng.integers(1, 9, 900), "mixed": rng.integers(1, 101, 600), "equal": np.full(400, 33)}[kind]
    df = spark.createDataFrame([(i, 0, 0, int(n), 0) for i, n in enumerate(sizes)],
                               "doc_id long, piece int, start long, length long, ids_crc32 long")
    rows = packing.place_pieces(df, 100).collect()
    assert len(rows) == len(sizes)
    assert _packed_well(rows, 100) <= 1.03 * _best_fit(sizes.tolist(), 100) + 1


def test_words_are_tokenised_as_the_text_is():
    from tokenizers import Tokenizer
    import public_tokenizers
    tok = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    ids = packing.WordIds(packing.TOKENIZER)
    texts = ["Don't  STOP\tit's 12.5€ naïve Å ́x 漢字😀<|endoftext|>a b<|startoftext|>", "ΑΣ Σ ſ İ ß ŉ ª", "a b c", "",
             "Wait... what?! (Yes)|no; É. é!! e\u0301! 5. x5! don't's. 's! ca't, A<|ENDOFTEXT|>! ñ*** ½.! ٣.%"]
    rng = np.random.default_rng(0)
    chars = list("aB'stdé\u0301É.,!?<|>5½ :\"-#*$%&() \n漢😀")
    texts += ["".join(rng.choice(chars, 60)) for _ in range(400)]
    texts += ["".join(map(chr, rng.integers(0x20, 0x250, 80))) for _ in range(200)]
    for _ in range(2):  # met for the first time, and remembered
        got, stops = ids([t.encode() for t in texts])
        for text, first, stop in zip(texts, [0, *stops], stops):
            assert got[first:stop].tolist() == tok.encode(text, add_special_tokens=False).ids + [0], text


def test_long_texts_are_handled_in_parts(monkeypatch):
    ids = packing.WordIds(packing.TOKENIZER)
    text = b"Some words, and more!\n" * 50 + "Ünd wörter é.".encode()
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "body": [text, b"x"]})
    want = [b.to_pylist() for b in packing._pieces(packing.TOKENIZER, 100, True, 0)([batch])]
    monkeypatch.setattr(packing, "BLOCK_BYTES", 40)
    got = [b.to_pylist() for b in packing._pieces(packing.TOKENIZER, 100, True, 0)([batch])]
    assert sum(got, []) == sum(want, []) and b"".join(r["ids"] for r in sum(got, []))[:-8] == ids([text])[0].tobytes()
    rng = np.random.default_rng(0)
    rows = [rng.integers(0, 20, n).astype(np.int32) for n in (0, 1, 2, 3, 50, 7, 90)]
    net = toxicity.Net(rng.normal(size=20), rng)
    tables, out = net.tables(), []
    for size in (1 << 18, 10):
        monkeypatch.setattr(toxicity, "SEGMENT", size)
        tops = np.full((len(rows), 3, toxicity.FILTERS), -np.inf)
        for block in toxicity._segments(rows):
            np.maximum.at(tops, [i for i, _ in block],
                          np.stack(net.pooled(tables, *toxicity._joined([p for _, p in block]))[0], 1))
        out.append(net.of_tops(tops))
    assert np.allclose(out[0], out[1])


def test_mix_messy(messy, no_docs):
    rows = mixing.mix(messy).collect()
    docs = messy.collect()
    assert len(rows) == len(docs)
    by = {}
    for r in rows:
        assert 0 <= r._repeats <= 3
        by.setdefault(r.source, []).append(r)
    total = sum(r._size for r in rows)
    assert sum(g[0]._target for g in by.values()) == pytest.approx(total)
    for g in by.values():
        assert g[0]._target <= 3 * g[0]._source_size + 1e-6
        taken = sum(r._size * r._repeats for r in g)
        assert abs(taken - g[0]._target) <= max(r._size for r in g)
    out = mixing.mixed_rows(messy)
    assert out.columns == messy.columns
    assert out.count() == sum(r._repeats for r in rows)
    assert mixing.mix(no_docs).count() == 0 and mixing.mixed_rows(no_docs).count() == 0


def test_chat_round_trip(spark):
    bad = r"\### Assistant: </turn> ok \b\l\h </turn"
    rows = [(1, 0, "system", "be\nkind"), (1, 1, "user", bad), (1, 2, "assistant", bad), (1, 3, "assistant", ""),
            (1, 4, "user", None), (2, 0, "user", "x"), (3, None, "assistant", "only"), (3, None, None, "z"),
            (None, 1, "assistant", "a"), (None, 1, "assistant", "a"), (4, 0, "a: </turn># b\\", "q" * 50_000),
            (4, 1, "assistant", "😀é")]
    df = spark.createDataFrame([(*r, "c") for r in rows], "conv_id long, turn long, role string, text string, turns string")
    found = chat.examples(df).select(
        "*", chat.read_turns(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("formatted"), F.col("loss_start"), F.col("loss_end")).alias("loss")).collect()
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append((r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
    for conv, turns in by.items():
        turns = [t[2:] for t in sorted(turns)]
        got = sorted((r for r in found if r.conv_id == conv), key=lambda r: (r.target < 0, r.target))
        targets = [i for i, t in enumerate(turns) if t[0] == "assistant"]
        assert [r.target for r in got if r.target >= 0] == targets
        for r in got:
            upto = len(turns) if r.target < 0 else r.target + 1
            assert [tuple(t) for t in r.turns] == turns[:upto]
            assert r.loss == ("" if r.target < 0 else turns[r.target][1])
        assert any(len(r.turns) == len(turns) for r in got)
    assert chat.examples(df.limit(0)).count() == 0


def _shards_hold(rows, docs, shards=16):
    assert len(rows) == len(docs)
    by = {}
    for r in rows:
        by.setdefault(r._shard, []).append(r._slot)
    assert all(0 <= s < shards for s in by)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_shards_messy(messy, no_docs):
    _shards_hold(sharding.shard_rows(messy).collect(), messy.collect())
    assert sharding.shard_rows(no_docs).count() == 0


def test_shards_are_even_and_keep_groups(spark):
    rows = [(i, f"text {i % 900} " + "y" * (i % 97)) for i in range(3000)] + [(5000 + i, "hot " * 30) for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = sharding.shard_rows(df).collect()
    _shards_hold(out, rows)
    size, where = [0] * 16, {}
    for r in out:
        size[r._shard] += r._size
        where.setdefault(r.text, set()).add(r._shard)
    assert max(size) - min(size) < 0.1 * sum(size) / 16
    assert sum(len(s) > 1 for s in where.values()) == 1  # the hot text alone


def test_rows_are_placed_among_keys_as_pairs_compare():
    rng = np.random.default_rng(8)
    keys = sorted({(int(a), int(b)) for a, b in rng.integers(-3, 4, (40, 2))}
                  | {(2, sharding.LOWEST), (-(1 << 63), sharding.LOWEST), ((1 << 63) - 1, 5)})
    h, d = rng.integers(-4, 5, 500), rng.integers(-4, 5, 500)
    d[:50] = sharding.LOWEST
    h[50:60] = (1 << 63) - 1
    got = sharding.place(h, d, keys)
    assert got.tolist() == [sum(k <= (a, b) for k in keys) for a, b in zip(h.tolist(), d.tolist(), strict=True)]
    assert sharding.place(h, d, []).tolist() == [0] * 500


@pytest.mark.parametrize("limit", [0, 16 << 20])
def test_a_mix_is_the_same_however_the_plan_is_joined(spark, monkeypatch, limit):
    monkeypatch.setattr(mixing, "BROADCAST_BYTES", limit)
    rows = [(i, "w " * (i % 7), None if i % 11 == 0 else "hot" if i % 3 else f"s{i % 5}") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df)
    taken = {r.doc_id: (r._size, r._target, r._repeats) for r in got.collect()}
    monkeypatch.setattr(mixing, "BROADCAST_BYTES", 1 << 30)
    assert len(taken) == 600
    assert taken == {r.doc_id: (r._size, r._target, r._repeats) for r in mixing.mix(df).collect()}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert ("_p_salt" in plan) == (limit == 0)


LINES = {"en": "the quick brown fox jumps over the lazy dog and then this thing was there with them",
         "de": "der schnelle braune fuchs springt über den faulen hund und nicht auf die kleinen katzen",
         "fr": "le renard brun rapide saute par dessus le chien paresseux et cela n'était pas très élégant"}


def _lines(spark, n=60):
    rng = np.random.default_rng(0)
    rows = [(i, " ".join(rng.permutation(LINES[lang].split())), lang, "s")
            for i, lang in enumerate(list(LINES) * n)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def test_language_id(spark, messy, no_docs):
    docs = _lines(spark)
    got = langid.scored_documents(docs).join(docs, "doc_id").collect()
    held = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert held and all(r.lang_pred == r.lang and 0 <= r.score <= 1 for r in held)
    junk = spark.createDataFrame([(9000, "漢字" * 200, "en", "s"), (9001, "42 !!", "en", "s"), (9002, None, None, None)],
                                 docs.schema)
    kept = langid.keep_accepted(docs.unionByName(junk))
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert set(range(180)) <= ids and not ids & {9001, 9002}
    out = langid.keep_accepted(messy)
    assert out.columns == messy.columns
    assert {r.doc_id for r in out.collect()}.isdisjoint({2, 3, 4, 7, 10})
    assert langid.keep_accepted(no_docs).count() == 0 and langid.scored_documents(no_docs).count() == 0


def test_language_id_rejects_what_is_not_learned(spark):
    docs = _lines(spark)
    rng = np.random.default_rng(1)
    finnish = "kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan heille on annettu järki "
    half = " ".join(LINES["en"].split() * 4)
    junk = {"han": "漢字" * 200, "hex": "".join(rng.choice(list("0123456789abcdef"), 2000)),
            "letters": " ".join("".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(200)),
            "finnish": finnish * 4, "half finnish": half + " " + (finnish * 9)[:len(half)]}
    # ids of held-out rows, which aren't trained on
    ids = [i for i in range(9000, 9200) if zlib.crc32(str(i).encode()) % 4 == 2]
    rows = [(i, text, "en", "s") for i, text in zip(ids, junk.values(), strict=False)]
    every = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    kept = {r.doc_id for r in langid.keep_accepted(every).collect()}
    gone = dict(zip(junk, ids, strict=False))
    assert not {name for name, i in gone.items() if i in kept}
    assert kept == set(range(180))
    # row 9000 must go as well if it isn't among the training rows
    row = spark.createDataFrame([(9000, "漢字" * 200, None, "s")], docs.schema)
    assert 9000 not in {r.doc_id for r in langid.keep_accepted(docs.unionByName(row)).collect()}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_language_id_keeps_held_out_documents(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    lost = langid.scored_documents(docs).filter(
        langid.held_out() & (F.col("symbols") > 0) & langid.rejected(langid.calibrate(docs)))
    assert lost.count() == 0


def test_language_model_is_a_distribution():
    g, _ = langid.grams([t * 3 for t in LINES.values()])
    gram, n = np.unique(g, return_counts=True)
    m = langid.kneser_ney(gram, n)
    contexts = np.unique(gram >> langid.BITS)[:20]
    for h in contexts.tolist():
        low = np.exp(m["lower"][(np.arange(64) | (h << 6)) & (2 ** 18 - 1)].astype(float))
        p = np.exp(m["back"][h].astype(float)) * low
        for s in range(64):
            i = np.searchsorted(m["gram"], h << 6 | s)
            if i < len(m["gram"]) and m["gram"][i] == h << 6 | s:
                p[s] = np.exp(float(m["logp"][i]))
        assert p.sum() == pytest.approx(1, abs=1e-3)


def test_toxicity_learns_and_survives_messy_tables(spark, messy, no_docs):
    rng = np.random.default_rng(3)
    vocab = [f"w{i}" for i in range(300)]
    rows, marks = [], []
    for i in range(800):
        words = rng.choice(vocab, 40).tolist()
        bad = i % 4 == 0
        if bad:
            words[int(rng.integers(40))] = ["Idiot!", "SCUM"][i % 8 // 4]
        rows.append((i, " ".join(words), "en"))
        marks.append((i, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([*marks, (None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.fit(*toxicity.sample(docs, labels))
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    held = [i for i in got if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(got[i] >= 0.5) == (i % 4 == 0) for i in held]) > 0.95
    scores = toxicity.score(messy, model).collect()
    assert len(scores) == messy.count() and all(0 <= r.score <= 1 for r in scores)
    assert toxicity.score(no_docs, model).count() == 0
    assert toxicity.fit(*toxicity.sample(docs, labels.limit(0))) is None
    assert toxicity.score(docs, None).filter("score = 0").count() == 800


def test_toxicity_thresholds_of_rare_languages(spark):
    rng = np.random.default_rng(4)
    rows, marks = [], []
    for i in range(3000):
        rare, bad = i % 20 == 7, bool(rng.random() < 0.4)
        words = rng.choice([f"слово{k}" if rare else f"word{k}" for k in range(60)], 30).tolist()
        # in the rare language one mark alone means nothing
        words[:3] = ["scum"] * (3 if bad else 1) if rare else ["scum"] * (1 if bad else 0) + words[:3 - bad]
        rows.append((i, " ".join(words) + (" vile" if bad and rare else ""), "ru" if rare else "en"))
        marks.append((i, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    fitted = toxicity.fit(*toxicity.sample(docs, labels, 150))
    model = toxicity.calibrated(fitted, docs, labels)
    logit = {r.doc_id: r.score for r in toxicity.score(docs, {**fitted, "thresholds": np.zeros(2)}).collect()}
    seen = {int(i) for i, _ in fitted["used"]}
    own = [i for i in range(7, 3000, 20) if i not in seen and zlib.crc32(str(i).encode()) % 5]
    y = np.array([marks[i][1] for i in own])
    z = np.array([logit[i] for i in own])
    z = np.log(z / (1 - z))
    f1 = lambda t: 2 * ((z >= t) & (y == 1)).sum() / ((z >= t).sum() + y.sum())
    best = max(f1(t) for t in z)
    # languages are sorted: en, ru
    assert f1(model["thresholds"][1]) >= best - 0.02 and f1(fitted["thresholds"][1]) < best - 0.02


def test_pipeline_stages(spark, messy, no_docs, tmp_path):
    for start in (messy, no_docs):
        docs = start
        for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
            path = str(tmp_path / f"{start is messy}-{i}")
            stage(spark, docs, SMALL_SF).write.parquet(path)
            out = spark.read.parquet(path)
            if i < 4:
                assert out.columns == docs.columns, name
            docs = out
        assert {"doc_id", "piece", "sequence_id", "offset"} <= set(docs.columns)


def test_pipeline_removes_copies_and_is_stable(spark):
    first = sorted(map(tuple, corpus_pipeline.run(spark, SMALL_SF).select("doc_id", "piece", "length").collect()))
    again = sorted(map(tuple, corpus_pipeline.run(spark, SMALL_SF).select("doc_id", "piece", "length").collect()))
    assert first == again and first
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL_SF}/documents.parquet").collect()}
    texts = [hashlib.sha256("".join(docs[i].split()).encode()).hexdigest() for i in {r[0] for r in first}]
    assert len(texts) == len(set(texts))
