"""Language ID with interpolated Kneser-Ney character models.

Letters are case-folded and mapped to 63 symbols (a-z have one each, all
others share the rest by hash); everything else is a word boundary, runs of
it count once.  The grams of four symbols are counted over all training texts,
per language, in Spark.  From the counts of a language one task builds its
model: interpolated Kneser-Ney with an absolute discount per order, lower
orders from continuation counts.  A model is stored in sorted arrays of gram
hashes with their log probabilities, and dense tables for the lower orders.
A gram has 24 bits, so a model has at most 2^24 entries whatever the corpus;
in practice it is far smaller.

A document goes to the language with the lowest cross-entropy per symbol.
Whether it is in any learned language is seen by stretches of ``STRETCH``
symbols, each by the language that fits it best, so that a document in two
learned languages isn't taken for one in another.  It is rejected if their
cross-entropy is further above the mean of the language's own documents than
``REJECT_SD`` standard deviations allow (more for short texts, whose
cross-entropy scatters more), or no better than chance.  Mean and deviation
are those of training documents under models that didn't learn them: each
half of them is scored by models of the other.

Defined results: null texts and texts without a letter are ``und`` with
score 0 and are rejected; rows with null lang don't train; without any
training row all are ``und``; of languages with equal cross-entropy the first
by name is taken; very long texts are scored whole, in blocks of ``BLOCK``
characters, each of which starts at a boundary; repeated rows train as often
as they occur and are scored alike; an
empty table gives an empty result; extra columns are carried by
``keep_accepted`` and ignored by ``identify``.
"""

from __future__ import annotations

import unicodedata
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from corpuslens.llm.common import boxed, prepared, query, table, unboxed

ORDER, BITS = 4, 6
SYMBOLS = 1 << BITS
GRAMS = 1 << (BITS * ORDER)
#: symbols in a task's buffer before grams are counted and merged
BUFFER = 1 << 20
#: characters that are looked at together
BLOCK = 1 << 18
REJECT_SD = 8.0
#: cross-entropies of texts shorter than this scatter more
STEADY = 400.0
#: symbols over which a text is taken to stay in one language
STRETCH = 128
#: documents' worth of all languages' deviation in that of each language
POOLED = 10
#: sharpness of the score over cross-entropies in nats per symbol
SHARPNESS = 4.0

_TABLES: dict = {}


def _symbol_of(cp: int) -> int:
    c = chr(cp)
    if not unicodedata.category(c).startswith("L"):
        return 0
    low = c.lower()
    v = ord(low[0])
    if 97 <= v <= 122:
        return v - 96
    return 27 + (v * 40503 >> 4) % (SYMBOLS - 27)


def symbol_table() -> np.ndarray:
    if "sym" not in _TABLES:
        _TABLES["sym"] = np.array([0 if 0xD800 <= i < 0xE000 else _symbol_of(i) for i in range(1 << 16)], np.uint32)
    return _TABLES["sym"]


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(gram, index of its text) of all texts; each starts with boundaries."""
    joined = np.frombuffer("".join(["\n" + t for t in texts]).encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    first = np.cumsum(size) - size
    sym = symbol_table()[np.minimum(joined, 0xFFFF)]
    wide = np.flatnonzero(joined > 0xFFFF)
    if len(wide):
        cps, inv = np.unique(joined[wide], return_inverse=True)
        sym[wide] = np.array([_symbol_of(int(c)) for c in cps], np.uint32)[inv]
    sym[first] = 0
    keep = sym != 0
    keep[1:] |= sym[:-1] != 0
    keep[first] = True
    doc = np.repeat(np.arange(len(texts)), size)[keep]
    sym = sym[keep]
    # two more boundaries in front of each text
    at = np.arange(len(sym)) + 2 * (doc + 1)
    row = np.zeros(len(sym) + 2 * len(texts), np.uint32)
    row[at] = sym
    starts = np.zeros(len(sym), bool)
    starts[np.flatnonzero(np.diff(doc, prepend=-1))] = True
    at, doc = at[~starts], doc[~starts]
    g = row[at]
    for back in range(1, ORDER):
        g = g | (row[at - back] << np.uint32(BITS * back))
    return g, doc


def text_blocks(texts: list[str], limit: int = BLOCK):
    """Lists of (index, text) with about ``limit`` characters; a longer text is
    cut into pieces of that length, each of which starts at a boundary."""
    block, held = [], 0
    for i, t in enumerate(texts):
        for at in range(0, max(len(t), 1), limit):
            part = t[at:at + limit]
            block.append((i, part))
            held += len(part)
            if held >= limit:
                yield block
                block, held = [], 0
    if block:
        yield block


def _merge(a, b):
    """Sum of two (sorted grams, counts)."""
    g, inv = np.unique(np.concatenate([a[0], b[0]]), return_inverse=True)
    return g, np.bincount(inv, np.concatenate([a[1], b[1]]), len(g)).astype(np.int64)


def _count(batches):
    held, size, total = {}, {}, {}

    def settle(lang):
        g, n = np.unique(np.concatenate(held.pop(lang)), return_counts=True)
        size[lang] = 0
        total[lang] = _merge(total[lang], (g, n)) if lang in total else (g, n)

    for b in batches:
        d = b.to_pydict()
        by = {}
        for lang, text in zip(d["lang"], d["text"], strict=True):
            by.setdefault(lang, []).append(text)
        for lang, texts in by.items():
            for block in text_blocks(texts):
                g, _ = grams([t for _, t in block])
                held.setdefault(lang, []).append(g)
                size[lang] = size.get(lang, 0) + len(g)
                if size[lang] > BUFFER:
                    settle(lang)
    for lang in list(held):
        settle(lang)
    for lang, (g, n) in total.items():
        for i in range(0, len(g), 1 << 16):
            part = slice(i, i + (1 << 16))
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(g[part])),
                                              "gram": pa.array(g[part].astype(np.int32)), "n": pa.array(n[part])})


def gram_counts(training: DataFrame) -> DataFrame:
    """(lang, gram, n) over all rows of ``training(text, lang)``."""
    prepared(training.sparkSession)
    return (training.filter("text is not null and lang is not null")
            .select("text", F.col("lang").cast("string").alias("lang"))
            .mapInArrow(_count, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")))


def _discount(n):
    once, twice = (n == 1).sum(), (n == 2).sum()
    return once / (once + 2 * twice) if once and twice else 0.5


def kneser_ney(gram: np.ndarray, n: np.ndarray) -> dict:
    """Tables of one language: sorted ``gram`` with ``logp``, dense log
    probabilities of the order below (``lower``) and log weight with which a
    context backs off to it (``back``)."""
    order = np.argsort(gram)
    gram, n = gram[order].astype(np.int64), n[order].astype(np.float64)
    # orders below: continuation counts = distinct symbols in front
    levels, g = [(gram, n)], gram
    for k in range(ORDER - 1, 0, -1):
        short, types = np.unique(g & ((1 << (BITS * k)) - 1), return_counts=True)
        levels.append((short, types.astype(np.float64)))
        g = short
    p = np.full(1, 1.0 / SYMBOLS)
    for k in range(1, ORDER):
        short, c = levels[ORDER - k]
        d, contexts = _discount(c), 1 << (BITS * (k - 1))
        total = np.bincount(short >> BITS, c, contexts)
        kinds = np.bincount(short >> BITS, minlength=contexts)
        weight = np.where(total > 0, d * kinds / np.maximum(total, 1), 1.0)
        base = np.tile(p, SYMBOLS) if k > 1 else np.full(SYMBOLS, p[0])
        # gram id = context, symbol; its lower order drops the oldest symbol
        full = np.repeat(weight, SYMBOLS) * base
        full[short] += np.maximum(c - d, 0) / total[short >> BITS]
        p = full
    d, contexts = _discount(n), 1 << (BITS * (ORDER - 1))
    total = np.bincount(gram >> BITS, n, contexts)
    kinds = np.bincount(gram >> BITS, minlength=contexts)
    back = np.where(total > 0, d * kinds / np.maximum(total, 1), 1.0)
    below = p[gram & ((1 << (BITS * (ORDER - 1))) - 1)]
    logp = np.log(np.maximum(n - d, 0) / total[gram >> BITS] + back[gram >> BITS] * below)
    return {"gram": gram.astype(np.uint32), "logp": logp.astype(np.float32),
            "lower": np.log(p).astype(np.float32), "back": np.log(back).astype(np.float32)}


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    m = kneser_ney(pdf["gram"].to_numpy(), pdf["n"].to_numpy())
    return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], **{k: [v.tobytes()] for k, v in m.items()}})


def train(training: DataFrame) -> dict:
    """{lang: tables} of all languages in ``training(text, lang)``."""
    rows = (gram_counts(training).groupBy("lang")
            .applyInPandas(_build, "lang string, gram binary, logp binary, lower binary, back binary").collect())
    kinds = {"gram": np.uint32, "logp": np.float32, "lower": np.float32, "back": np.float32}
    return {r["lang"]: {k: np.frombuffer(r[k], t) for k, t in kinds.items()}
            for r in sorted(rows, key=lambda r: r["lang"])}


class Scorer:
    """All models side by side: sorted union of the grams, a row for each."""

    def __init__(self, models: dict):
        self.langs = list(models)
        union = np.unique(np.concatenate([m["gram"] for m in models.values()]))
        self.row = np.full(GRAMS, -1, np.int32)
        self.row[union] = np.arange(len(union))
        low = (1 << (BITS * (ORDER - 1))) - 1
        self.lower = np.stack([m["lower"] for m in models.values()], 1)
        self.back = np.stack([m["back"] for m in models.values()], 1)
        self.logp = self.back[union >> BITS] + self.lower[union & low]
        for j, m in enumerate(models.values()):
            self.logp[np.searchsorted(union, m["gram"]), j] = m["logp"]

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cross-entropy per symbol and language, that of its stretches by the
        best language of each, and symbols, of each text (0 symbols: it has no
        letter)."""
        total, fit = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts))
        n, letters = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        for block in text_blocks(texts):
            of = np.array([i for i, _ in block])
            g, doc = grams([t for _, t in block])
            at = self.row[g]
            lp = self.logp[at]
            new = np.flatnonzero(at < 0)
            lp[new] = self.back[g[new] >> BITS] + self.lower[g[new] & ((1 << (BITS * (ORDER - 1))) - 1)]
            size = np.bincount(doc, minlength=len(block))
            inner = np.arange(len(doc)) - np.repeat(np.cumsum(size) - size, size)
            start = np.flatnonzero(inner % STRETCH == 0)
            if len(start):
                sums = np.add.reduceat(lp, start, axis=0, dtype=np.float64)
                np.add.at(total, of[doc[start]], sums)
                np.add.at(fit, of[doc[start]], sums.max(1))
            np.add.at(n, of, size)
            np.add.at(letters, of, np.bincount(doc[(g & (SYMBOLS - 1)) != 0], minlength=len(block)))
        per = np.maximum(n, 1)
        return -total / per[:, None], -fit / per, np.where(letters > 0, n, 0)


def _scores(shared):
    def run(batches):
        if "scorer" not in _TABLES or _TABLES["of"] != shared.value["id"]:
            _TABLES.pop("scorer", None)
            _TABLES["scorer"], _TABLES["of"] = Scorer(shared.value["models"]), shared.value["id"]
        scorer = _TABLES["scorer"]
        for b in batches:
            column = b.column("text") if "text" in b.schema.names else b.column("_row").field("text")
            texts = ["" if t is None else t for t in column.to_pylist()]
            h, fit, n = scorer(texts)
            k = h.argmin(1)
            low = h[np.arange(len(k)), k]
            share = np.exp(-SHARPNESS * (h - low[:, None])).sum(1)
            best = [scorer.langs[x] if m else "und" for x, m in zip(k, n, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in b.schema.names if c != "text"], pa.array(best, pa.string()), pa.array(fit),
                 pa.array(np.where(n > 0, 1 / share, 0.0)), pa.array(n)],
                [*[c for c in b.schema.names if c != "text"], "lang_pred", "xent", "score", "symbols"])
    return run


def identify(docs: DataFrame, models: dict, carry: list[str] = ("doc_id",)) -> DataFrame:
    """The ``carry`` columns of every row plus lang_pred, xent, score, symbols;
    the text is that of ``_row`` if that is carried."""
    spark = docs.sparkSession
    prepared(spark)
    out = StructType([docs.schema[c] for c in carry] + [
        StructField("lang_pred", StringType()), StructField("xent", DoubleType()),
        StructField("score", DoubleType()), StructField("symbols", LongType())])
    if not models:
        return docs.select(*carry, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("xent"),
                           F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("symbols"))
    shared = spark.sparkContext.broadcast({"id": uuid.uuid4().hex, "models": models})
    needed = carry if "_row" in carry else [*carry, "text"]
    return docs.select(*needed).mapInArrow(_scores(shared), out)


def _weight():
    return F.sqrt(F.least(F.greatest(F.col("symbols"), F.lit(1)) / F.lit(STEADY), F.lit(1.0)))


def calibrate(docs: DataFrame) -> dict[str, tuple[float, float]]:
    """Mean and deviation of the cross-entropy per language, over training
    documents that got their own language from models of the other half of
    them; deviations of short texts are scaled to those of long ones."""
    rows = docs.filter(~held_out() & F.col("lang").isNotNull()).select(
        "text", F.col("lang").cast("string").alias("lang"), F.coalesce(half(), F.lit(0)).alias("half"))
    w, x = _weight(), F.col("xent")
    sums: dict = {}
    for k in (0, 1):
        tagged = rows.filter(F.col("half") == k).withColumnRenamed("lang", "_lang")
        own = identify(tagged, train(rows.filter(F.col("half") != k)), ["_lang"]).filter(
            "lang_pred = _lang and symbols > 0")
        for lang, *found in own.groupBy("lang_pred").agg(
                F.sum(w), F.sum(w * x), F.sum(w * w), F.sum(w * w * x), F.sum(w * w * x * x), F.count("*")).collect():
            sums[lang] = sums.get(lang, 0) + np.array(found, float)
    if not sums:
        return {}
    mean = {k: v[1] / v[0] for k, v in sums.items()}
    square = {k: max(v[4] - 2 * mean[k] * v[3] + mean[k] ** 2 * v[2], 0.0) for k, v in sums.items()}
    pooled = sum(square.values()) / sum(v[5] for v in sums.values())
    return {k: (float(mean[k]), float(np.sqrt((square[k] + POOLED * pooled) / (v[5] + POOLED))))
            for k, v in sorted(sums.items())}


def rejected(limits: dict[str, tuple[float, float]]):
    """Column: the document is in none of the learned languages."""
    spread = REJECT_SD / _weight()
    bound = F.lit(None).cast("double")
    for lang, (m, s) in limits.items():
        # equal texts may differ in the last digits
        bound = F.when(F.col("lang_pred") == lang, F.lit(m + 1e-9) + spread * F.lit(s)).otherwise(bound)
    chance = F.lit(float(np.log(SYMBOLS)))
    return (F.col("symbols") == 0) | (F.col("xent") >= chance) | F.coalesce(F.col("xent") > bound, F.lit(False))


def held_out(doc_id="doc_id", parts: int = 4, which: int = 2):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts == which, F.lit(False))


def half(doc_id="doc_id"):
    return F.floor(F.crc32(F.col(doc_id).cast("string").cast("binary")) / 4) % 2


def scored_documents(docs: DataFrame) -> DataFrame:
    """Scores of all documents by models learned from those not held out."""
    return identify(docs, train(docs.filter(~held_out())))


def keep_accepted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that aren't rejected, with all their columns."""
    models = train(docs.filter(~held_out()))
    rows = boxed(docs).withColumn("text", F.col("_row.text"))
    return unboxed(identify(rows, models, ["_row"]).filter(~rejected(calibrate(docs))))


@query("op10_language_id")
def op10_language_id(spark, sf_dir):
    """Predicted language of every document."""
    docs = table(spark, sf_dir, "documents")
    return scored_documents(docs).select("doc_id", held_out().alias("held_out"), "lang_pred", "score",
                                         rejected(calibrate(docs)).alias("rejected"))
