"""Classifiers and the pipeline against plain loops over small tables."""

import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash

import corpus_pipeline
from corpuslens.llm import langid, mixing, packing, simhash, toxicity
from test_llm_pipeline import LINES, _best_fit, _packed_well

DOCS = "doc_id long, text string, lang string, source string"


# -- the convolutional classifier

def _plain_logit(net, ids):
    ids = list(ids) + [0] * (max(toxicity.WIDTHS) - len(ids))
    p = {k: v.astype(float) for k, v in net.p.items()}
    z = p["shift"][0]
    for k, w in enumerate(toxicity.WIDTHS):
        for f in range(toxicity.FILTERS):
            top = max(sum(p["emb"][ids[i + j]] @ p[f"f{w}"][j][:, f] for j in range(w)) for i in range(len(ids) - w + 1))
            z += max(top + p["bias"][k, f], 0) * p["out"][k * toxicity.FILTERS + f]
    return z


def test_the_network_computes_what_plain_loops_do():
    rng = np.random.default_rng(5)
    net = toxicity.Net(rng.normal(size=30), rng)
    texts = [rng.integers(0, 30, n).astype(np.int32) for n in (0, 1, 2, 3, 4, 9, 40, 3, 0)]
    got = net.logits(net.tables(), *toxicity._joined(texts))
    assert np.allclose(got, [_plain_logit(net, t) for t in texts], atol=1e-4)


def test_one_step_goes_down_the_slope():
    """The first step of Adam moves each weight by the rate against the sign
    of its slope, here measured by differences."""
    rng = np.random.default_rng(6)
    net = toxicity.Net(rng.normal(size=12), rng)
    texts = [rng.integers(0, 12, n).astype(np.int32) for n in (6, 3, 8, 5)]
    y, weight = np.array([1, 0, 1, 0], np.float32), np.array([1, 2, 0.5, 1], np.float32)

    def loss():
        z = np.array([_plain_logit(net, t) for t in texts])
        return float((weight * (np.log1p(np.exp(z)) - y * z)).mean())

    slopes = {}
    for name, v in net.p.items():
        for at in rng.permutation(v.size)[:25]:
            old = v.flat[at]
            side = []
            for d in (1e-3, -1e-3):
                v.flat[at] = old + d
                side.append(loss())
            v.flat[at] = old
            slopes[name, at] = (side[0] - side[1]) / 2e-3
    before = {k: v.copy() for k, v in net.p.items()}
    net.train_on(*toxicity._joined(texts), y, weight)
    steep = {k: s for k, s in slopes.items() if abs(s) > 1e-3}
    assert len(steep) > 30
    for (name, at), s in steep.items():
        shrunk = before[name].flat[at] - toxicity.RATE * np.sign(s)
        shrunk *= 1 if name == "shift" else 1 - toxicity.RATE * toxicity.DECAY
        assert net.p[name].flat[at] == pytest.approx(shrunk, abs=1e-5), (name, at)


def _plain_cut(rows, negatives):
    """The best F1 of any cut through rows (step, label, weight)."""
    best = 0
    for cut in {s for s, _, _ in rows}:
        hit = sum(w for s, k, w in rows if k and s >= cut)
        wrong = sum(w for s, k, w in rows if not k and s >= cut) * negatives
        best = max(best, 2 * hit / (hit + wrong + sum(w for _, k, w in rows if k)))
    return best


def test_thresholds_move_with_the_rows_of_a_language():
    rng = np.random.default_rng(7)
    many = Counter((0, int(rng.normal(300 if k else -300, 200)), int(k)) for k in rng.random(4000) < 0.3)
    # language 1 lies elsewhere; it has ever more rows
    cuts = []
    for n in (0, 1, 4, 16, 64, 1024):
        few = Counter((1, int(rng.normal(1500 if k else 900, 60)), int(k)) for k in [True] * n + [False] * n)
        cuts.append(toxicity.thresholds(many + few, 1.0, 3)[1:])
    cuts = np.array(cuts)
    assert cuts[0, 0] == pytest.approx(cuts[0, 1])  # no rows of its own: that of all
    assert cuts[-1, 0] * toxicity.STEPS > 1000 and cuts[0, 0] * toxicity.STEPS < 300
    assert abs(cuts[1, 0] - cuts[0, 0]) < 0.5
    # nothing known: logit 0
    assert toxicity.thresholds({}, 1.0, 2).tolist() == [0.0, 0.0]
    rows = [(int(s), int(k), 1.0) for s, k in zip(rng.integers(-40, 40, 300), rng.random(300) < 0.4, strict=True)]
    for negatives in (1.0, 5.0):
        counts = Counter()
        for s, k, w in rows:
            counts[s, k] += w
        cut = toxicity._cut(counts, negatives) * toxicity.STEPS
        hit = sum(k for s, k, _ in rows if s >= cut)
        wrong = sum(1 - k for s, k, _ in rows if s >= cut) * negatives
        got = 2 * hit / (hit + wrong + sum(k for _, k, _ in rows))
        assert got == pytest.approx(_plain_cut(rows, negatives))


def test_the_fit_takes_a_bounded_number_of_words_and_rows(spark):
    rows = [(i, "word " * (5000 if i % 10 == 0 else 20), "en") for i in range(200)]
    # one doc_id with many rows is one document of the fit
    rows += [(7, f"other {i}", "en") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 2)) for i in range(200)], "doc_id long, toxic int")
    got, _ = toxicity.sample(docs, labels, 60, 6000)
    assert len({r.doc_id for r in got}) == len(got)
    for k in (0, 1):
        sizes = [len(r.words) // 4 for r in got if r.toxic == k]
        assert sum(sizes) <= 6000 and len(sizes) <= 60
        assert sizes.count(20) >= 20  # a long one takes nobody's place
    again, _ = toxicity.sample(docs.repartition(7), labels, 60, 6000)
    assert [r.doc_id for r in again] == [r.doc_id for r in got]


# -- the language models

def _symbols(text):
    out = [0, 0, 0]
    for c in text:
        s = langid._symbol_of(ord(c))
        if s or out[-1]:
            out.append(s)
    return out


def _events(text):
    s = _symbols(text)
    return [tuple(s[i - 3:i + 1]) for i in range(3, len(s))]


class Plain:
    """Interpolated Kneser-Ney by dictionaries."""

    def __init__(self, texts):
        top = Counter(g for t in texts for g in _events(t))
        self.level = [None] * 4 + [top]
        for k in (3, 2, 1):
            self.level[k] = Counter(g[1:] for g in self.level[k + 1])
        self.total, self.kinds, self.d = [None], [None], [None]
        for k in range(1, 5):
            total, kinds = Counter(), Counter()
            for g, n in self.level[k].items():
                total[g[:-1]] += n
                kinds[g[:-1]] += 1
            once, twice = (sum(n == m for n in self.level[k].values()) for m in (1, 2))
            self.total.append(total)
            self.kinds.append(kinds)
            self.d.append(once / (once + 2 * twice) if once and twice else 0.5)

    def p(self, g):
        k = len(g)
        if k == 0:
            return 1 / 64
        below, total = self.p(g[1:]), self.total[k][g[:-1]]
        if not total:
            return below
        return max(self.level[k][g] - self.d[k], 0) / total + self.d[k] * self.kinds[k][g[:-1]] / total * below


def _plain_models(rows):
    texts = defaultdict(list)
    for _, text, lang, _ in rows:
        if text is not None and lang is not None:
            texts[lang].append(text)
    return {lang: Plain(t) for lang, t in sorted(texts.items())}


def _plain_scores(models, text):
    """(language, cross-entropy by stretches, score, symbols)."""
    events = _events(text or "")
    if not any(g[-1] for g in events):
        return "und", 0.0, 0.0, 0
    logs = {lang: [math.log(m.p(g)) for g in events] for lang, m in models.items()}
    h = {lang: -sum(x) / len(events) for lang, x in logs.items()}
    best = min(h, key=lambda lang: (h[lang], lang))
    fit = -sum(max(sum(x[i:i + langid.STRETCH]) for x in logs.values())
               for i in range(0, len(events), langid.STRETCH)) / len(events)
    return best, fit, 1 / sum(math.exp(-langid.SHARPNESS * (v - h[best])) for v in h.values()), len(events)


def _crc(i):
    return zlib.crc32(str(i).encode())


def _plain_kept(rows):
    """doc_ids that language ID accepts, and (xent, bound) of each row."""
    train = [r for r in rows if r[0] is None or _crc(r[0]) % 4 != 2]
    weight = lambda n: math.sqrt(min(max(n, 1) / langid.STEADY, 1))
    own = defaultdict(list)
    half = lambda r: 0 if r[0] is None else _crc(r[0]) // 4 % 2
    for k in (0, 1):
        models = _plain_models([r for r in train if half(r) != k])
        for r in train:
            if half(r) == k and r[2] is not None:
                lang, fit, _, n = _plain_scores(models, r[1])
                if lang == r[2]:
                    own[lang].append((weight(n), fit))
    mean = {k: sum(w * x for w, x in v) / sum(w for w, _ in v) for k, v in own.items()}
    square = {k: sum((w * (x - mean[k])) ** 2 for w, x in v) for k, v in own.items()}
    pooled = sum(square.values()) / sum(map(len, own.values()))
    sd = {k: math.sqrt((square[k] + langid.POOLED * pooled) / (len(v) + langid.POOLED)) for k, v in own.items()}
    models, kept = _plain_models(train), []
    for r in rows:
        lang, fit, _, n = _plain_scores(models, r[1])
        if n and fit < math.log(64) and (lang not in mean or fit <= mean[lang] + langid.REJECT_SD / weight(n) * sd[lang]):
            kept.append(r)
    return kept


def _corpus(n):
    """Three languages, copies, near copies, junk, nulls, several sources."""
    rng = np.random.default_rng(9)
    rows = []
    for i in range(n):
        lang = list(LINES)[i % 3]
        text = " ".join(" ".join(rng.permutation(LINES[lang].split())) for _ in range(1 + i % 4))
        rows.append((i, text, lang, [None, "a", "b", "c", "hot"][min(i % 7, 4)]))
    for i in range(0, 20, 2):
        rows.append((1000 + i, rows[i][1].replace(" ", "\n  "), rows[i][2], "copies"))
        rows.append((1001 + i, rows[i][1], None, "copies"))
    for i in range(8):
        lang = list(LINES)[i % 3]
        words = " ".join(" ".join(rng.permutation(LINES[lang].split())) for _ in range(60)).split()
        rows.append((2000 + 2 * i, " ".join(words), lang, "long"))
        words[int(rng.integers(len(words)))] = "the"
        rows.append((2001 + 2 * i, " ".join(words), lang, "long"))
    rows += [(3000, "漢字" * 200, None, "junk"), (3001, "42 !!", "en", "junk"), (3002, None, "de", "junk"), (3003, "", None, None),
             (3004, "".join(rng.choice(list("0123456789abcdef"), 900)), None, "junk")]
    return rows


def test_language_models_are_those_of_plain_loops(spark):
    rows = _corpus(45)
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    models = _plain_models([r for r in rows if _crc(r[0]) % 4 != 2])
    got = {r.doc_id: r for r in langid.scored_documents(docs).collect()}
    assert len(got) == len(rows)
    for i, text, _, _ in rows:
        lang, fit, score, n = _plain_scores(models, text)
        assert (got[i].lang_pred, got[i].symbols) == (lang, n)
        assert got[i].xent == pytest.approx(fit, abs=1e-4) and got[i].score == pytest.approx(score, abs=1e-3)


# -- the pipeline

_SPACE = re.compile(r"[\x20\x09-\x0D]+")


def _plain_exact(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[_SPACE.sub("", r[1] or "")].append(r)
    return [min(g, key=lambda r: (-len(r[1] or ""), r[0])) for g in groups.values()]


def _plain_print(text, words):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(w[i:i + words]) for i in range(max(len(w) - words + 1, 1))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _plain_near(rows):
    prints = {r[0]: _plain_print(r[1], simhash.WORDS) for r in rows}
    label = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for i in prints:
            for j in prints:
                if label[i] < label[j] and (prints[i] ^ prints[j]).bit_count() <= simhash.MAX_BITS:
                    label[j], changed = label[i], True
    return [r for r in rows if label[r[0]] == r[0]]


def _plain_repeats(rows):
    import pandas as pd
    con = duckdb.connect()
    con.register("docs", pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source"]))
    return dict(con.sql(mixing.MIX_SQL.replace("DOCS", "docs") + " select doc_id, repeats from mixed").fetchall())


def test_pipeline_keeps_places_and_repeats_what_plain_loops_do(spark, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer
    rows = _corpus(60)
    spark.createDataFrame(rows, DOCS).repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    kept = _plain_kept(rows)
    # clean documents stay, junk goes
    assert {r[0] for r in rows} - {r[0] for r in kept} == {3000, 3001, 3002, 3003, 3004}
    near = _plain_near(_plain_exact(kept))
    ids = {r[0] for r in near}
    assert not any(i >= 1000 and i < 2000 and i % 2 for i in ids) and len(near) < len(kept) - 10
    repeats = _plain_repeats(near)
    assert max(repeats.values()) > 1
    tok = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    want = Counter()
    for i, text, _, _ in near:
        body = np.array(tok.encode(text, add_special_tokens=False).ids + [0], "<u4")
        for k, at in enumerate(range(0, len(body), packing.CAPACITY)):
            part = body[at:at + packing.CAPACITY]
            want[i, k, at, len(part), zlib.crc32(part.tobytes())] += repeats[i]
    want = +want
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    n = _packed_well(got, packing.CAPACITY)
    assert n <= _best_fit([k[3] for k in want.elements()], packing.CAPACITY) + 1
