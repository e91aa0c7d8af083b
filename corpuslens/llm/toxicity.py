"""Toxicity by a convolutional text classifier, trained here in numpy.

Words are hashed to buckets with an embedding each; filters of several
widths slide over the whole text, the maximum of each filter over the text is
kept, and a linear layer over these maxima gives a logit.  Buckets that fewer
than ``MIN_DOCS`` training texts use share one embedding, so the network
can't learn texts by their rare words.  Embeddings start from how far a
bucket's document frequency differs between the classes (in standard
deviations beyond chance) in one coordinate and near zero in the others: a maximum over
thousands of random responses would otherwise drown the few that matter.

The network is fitted with Adam in ``EPOCHS`` passes, however many rows there
are, on at most ``SAMPLE`` labelled documents of each class with at most
``SAMPLE_WORDS`` words together (in hash order; a document that doesn't fit
into what is left of the words isn't among them), a fifth of which is kept
aside.  All labelled training rows that it wasn't fitted on are scored, and
their counts by language, logit and label give one threshold per language:
the cut with the best F1 among its own rows and ``PRIOR`` rows of each class
that are spread as those of all languages are.  So a language with few rows
stays near the common threshold and one with many finds its own, without a
border between them.  The language is guessed from the text alone, by its
byte frequencies.  The score is the logistic of logit minus threshold, so
0.5 is the calibrated boundary in every language.

Scoring is one pass over whole texts, in slices of bounded size; the model is
a few megabytes whatever the corpus.

Defined results: null and empty texts score as a text without known words;
null or unknown labels don't train, a document with several label rows trains
with the largest, and of several rows with one doc_id the fit takes the
smallest text; without both classes among the training rows every score is 0
and predicted 0; repeated rows score alike; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.common import prepared, query, saved, sized, table

BUCKETS, DIM, FILTERS, WIDTHS = 1 << 16, 8, 8, (1, 2, 3)
#: labelled documents of each class that the network is fitted on, at most
SAMPLE = 4000
#: words of the documents of a class that it is fitted on, at most
SAMPLE_WORDS = 1 << 24
MIN_DOCS, EPOCHS, BATCH, RATE, DECAY, SEED = 4, 8, 64, 0.01, 0.02, 7
#: rows of each class that all languages lend to the threshold of one
PRIOR = 10
#: logits are counted in steps of 1 / STEPS
STEPS = 256

_SEPARATE = bytes(c if chr(c).isalnum() or c > 127 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(_SEPARATE).split()


def bucket(word: bytes) -> int:
    return zlib.crc32(word) & (BUCKETS - 1)


def _featurize(batches):
    for b in batches:
        texts = b.column("text").to_pylist()
        words = [np.array([bucket(w) for w in words_of(t)], np.int32).tobytes() for t in texts]
        hist = [np.bincount(np.frombuffer((t or "").encode(), np.uint8), minlength=256).astype(np.int32).tobytes()
                for t in texts]
        yield pa.RecordBatch.from_arrays(
            [b.column("toxic"), b.column("lang"), pa.array(words, pa.binary()), pa.array(hist, pa.binary()),
             b.column("doc_id"), pa.array([len(w) // 4 for w in words], pa.int64())],
            ["toxic", "lang", "words", "hist", "doc_id", "n"])


def held_out(doc_id="doc_id", parts: int = 5):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts == 0, F.lit(False))


def training_labels(labels: DataFrame) -> DataFrame:
    return saved(labels.filter(~held_out() & F.col("toxic").isin(0, 1)).groupBy("doc_id")
                 .agg(F.max("toxic").cast("int").alias("toxic")))


def sample(docs: DataFrame, labels: DataFrame, size: int = SAMPLE, words: int = SAMPLE_WORDS) -> tuple[list, float]:
    """At most ``size`` training rows of each class, with at most ``words``
    words together, as word buckets, and how many labelled rows of class 0 one
    of them stands for, against class 1."""
    known = training_labels(labels)
    there = {r[0]: r[1] for r in known.groupBy("toxic").count().collect()}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = (known.filter("toxic = 1").orderBy(*order).limit(size)
              .unionByName(known.filter("toxic = 0").orderBy(*order).limit(size)))
    rows = (docs.select("doc_id", F.struct("text", F.col("lang").cast("string").alias("lang")).alias("d"))
            .join(F.broadcast(picked), "doc_id").groupBy("doc_id", "toxic").agg(F.min("d").alias("d")))
    features = saved(rows.orderBy(*order)
                     .select("toxic", "d.lang", "d.text", F.col("doc_id").cast("string").alias("doc_id"))
                     .mapInArrow(_featurize, "toxic int, lang string, words binary, hist binary, doc_id string, n long")
                     .withColumn("at", F.monotonically_increasing_id()))
    room, kept = {0: words, 1: words}, {0: [], 1: []}
    for at, toxic, n in sorted(features.select("at", "toxic", "n").collect()):
        if n <= room[toxic]:
            room[toxic] -= n
            kept[toxic].append((at,))
    chosen = docs.sparkSession.createDataFrame(kept[0] + kept[1], "at long")
    stands = [max(there.get(k, 0) / max(len(kept[k]), 1), 1.0) for k in (0, 1)]
    return sorted(features.join(F.broadcast(chosen), "at", "left_semi")
                  .select("toxic", "lang", "words", "hist", "doc_id", "at").collect(),
                  key=lambda r: r["at"]), stands[0] / stands[1]


class Net:
    """Embedding (row 0: all rare buckets), filters and output layer."""

    def __init__(self, spread: np.ndarray, rng):
        self.p = {"emb": rng.normal(0, 0.02, (len(spread), DIM)), "bias": np.zeros((len(WIDTHS), FILTERS)),
                  "out": np.full(len(WIDTHS) * FILTERS, 0.2), "shift": np.full(1, -1.0)}
        self.p["emb"][:, 0] = spread
        for w in WIDTHS:
            self.p[f"f{w}"] = rng.normal(0, 0.3, (w, DIM, FILTERS))
            self.p[f"f{w}"][:, 0] = np.abs(self.p[f"f{w}"][:, 0]) + 0.2
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        self.adam = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        self.step = 0

    def tables(self):
        """Per width and position, what each embedding adds to each filter."""
        return {w: [self.p["emb"] @ self.p[f"f{w}"][j] for j in range(w)] for w in WIDTHS}

    @staticmethod
    def pooled(tables, ids, starts):
        """Maxima of every filter over each text, and the responses."""
        tops, responses = [], []
        for w in WIDTHS:
            r = tables[w][0][ids]
            for j in range(1, w):
                r[:-j] += tables[w][j][ids[j:]]
            # windows that reach into the next text don't count
            for j in range(1, w):
                r[starts[1:] - j] = -np.inf
                r[len(ids) - j] = -np.inf
            tops.append(np.maximum.reduceat(r, starts, axis=0))
            responses.append(r)
        return tops, responses

    def logits(self, tables, ids, starts):
        tops, _ = self.pooled(tables, ids, starts)
        return self.of_tops(np.stack(tops, 1))

    def of_tops(self, tops):
        """Logits from the filters' maxima."""
        return np.maximum(tops + self.p["bias"], 0).reshape(len(tops), -1) @ self.p["out"] + self.p["shift"][0]

    def train_on(self, ids, starts, y, weight):
        tables = self.tables()
        tops, responses = self.pooled(tables, ids, starts)
        pre = np.stack([t + b for t, b in zip(tops, self.p["bias"], strict=True)], 1)
        z = np.maximum(pre, 0).reshape(len(y), -1)
        p = 1 / (1 + np.exp(-(z @ self.p["out"] + self.p["shift"][0])))
        d = ((p - y) * weight / len(y)).astype(np.float32)
        g = {"out": z.T @ d, "shift": np.array([d.sum()], np.float32)}
        dz = (d[:, None] * self.p["out"]).reshape(pre.shape) * (pre > 0)
        g["bias"] = dz.sum(0)
        g["emb"] = np.zeros_like(self.p["emb"])
        text = np.repeat(np.arange(len(y)), np.diff(np.append(starts, len(ids))))
        for k, w in enumerate(WIDTHS):
            # the first window that reaches the maximum gets the gradient
            at, f = np.nonzero(responses[k] == tops[k][text])
            _, first = np.unique(text[at] * FILTERS + f, return_index=True)
            at, f = at[first], f[first]
            share = dz[text[at], k, f]
            gf = np.zeros_like(self.p[f"f{w}"])
            for j in range(w):
                m = np.zeros((len(self.p["emb"]), FILTERS), np.float32)
                np.add.at(m, (ids[at + j], f), share)
                g["emb"] += m @ self.p[f"f{w}"][j].T
                gf[j] = self.p["emb"].T @ m
            g[f"f{w}"] = gf
        self.step += 1
        rate = RATE * np.sqrt(1 - 0.999 ** self.step) / (1 - 0.9 ** self.step)
        for k, v in g.items():
            m, s = self.adam[k]
            m += 0.1 * (v - m)
            s += 0.001 * (v * v - s)
            self.p[k] -= rate * m / (np.sqrt(s) + 1e-8)
            if k != "shift":
                self.p[k] *= 1 - RATE * DECAY


#: words that are convolved at a time
SEGMENT = 1 << 18


def _segments(rows: list[np.ndarray]):
    """Lists of (row, ids) with about SEGMENT ids; a longer row is cut, its
    pieces overlapping by the widest filter less one, so that no window is lost."""
    block, held, over = [], 0, max(WIDTHS) - 1
    for i, ids in enumerate(rows):
        for at in range(0, max(len(ids) - over, 1), SEGMENT):
            part = ids[at:at + SEGMENT + over]
            block.append((i, part))
            held += len(part)
            if held >= SEGMENT:
                yield block
                block, held = [], 0
    if block:
        yield block


def _joined(texts: list[np.ndarray]):
    """Texts in a row, each with at least as many ids as the widest filter."""
    padded = [t if len(t) >= max(WIDTHS) else np.concatenate([t, np.zeros(max(WIDTHS) - len(t), np.int32)])
              for t in texts]
    size = np.fromiter(map(len, padded), np.int64, len(padded))
    return np.concatenate(padded), np.cumsum(size) - size


def _cut(counts: dict, negatives: float) -> float:
    """Middle of the cut with the best F1 for label 1, from {(step, label):
    rows}, where a row of label 0 stands for ``negatives`` of them."""
    steps = np.array(sorted({b for b, _ in counts}, reverse=True))
    n = [np.array([counts.get((b, k), 0) for b in steps], float) for k in (0, 1)]
    hit, wrong = np.cumsum(n[1]), np.cumsum(n[0]) * negatives
    i = int((2 * hit / (hit + wrong + n[1].sum())).argmax())
    return float((steps[i] + (steps[i + 1] + 1 if i + 1 < len(steps) else steps[i])) / 2 / STEPS)


def thresholds(counts: dict, negatives: float, langs: int) -> np.ndarray:
    """One threshold per language from {(language, step, label): rows}.

    All languages together start from ``PRIOR`` rows of each class that logit
    0 parts, each language from as many that are spread as all of them."""
    every = Counter({(0, 1): PRIOR, (-1, 0): PRIOR})
    own = [Counter() for _ in range(langs)]
    for (lang, step, label), n in counts.items():
        every[step, label] += n
        own[lang][step, label] += n
    total = [sum(n for (_, label), n in every.items() if label == k) for k in (0, 1)]
    lent = Counter({(step, label): PRIOR * n / total[label] for (step, label), n in every.items()})
    return np.array([_cut(lent + c, negatives) for c in own])


def _step(logit: np.ndarray) -> np.ndarray:
    return np.floor(np.clip(logit.astype(np.float64), -50, 50) * STEPS).astype(np.int32)


def fit(rows: list, negatives: float = 1.0, epochs: int = EPOCHS) -> dict | None:
    """The model from rows (toxic, lang, words, hist, doc_id), where a row of label 0
    stands for ``negatives`` labelled ones; None without both classes."""
    y = np.array([r[0] for r in rows], np.float32)
    if len(rows) == 0 or y.min() == y.max():
        return None
    raw = [np.frombuffer(r[2], np.int32) for r in rows]
    aside = np.arange(len(rows)) % 5 == 4
    used = np.zeros((2, BUCKETS))
    for t, k, a in zip(raw, y, aside, strict=True):
        if not a:
            used[int(k), np.unique(t)] += 1
    remap = np.zeros(BUCKETS, np.int32)
    common = np.flatnonzero(used.sum(0) >= MIN_DOCS)
    remap[common] = 1 + np.arange(len(common))
    texts = [remap[t] for t in raw]
    n = np.maximum([(y[~aside] == k).sum() for k in (0, 1)], 1)
    rate = (used.sum(0)[common] + 1) / (n.sum() + 2)
    spread = (used[1, common] / n[1] - used[0, common] / n[0]) / np.sqrt(rate * (1 - rate) * (1 / n).sum())
    # what chance alone brings about among so many buckets counts as nothing
    chance = np.sqrt(2 * np.log(max(len(common), 2)))
    spread = np.sign(spread) * np.maximum(np.abs(spread) - chance, 0)
    rng = np.random.default_rng(SEED)
    net = Net(np.concatenate([[0.0], spread / 8]), rng)
    train = np.flatnonzero(~aside)
    share = y[train].mean() if 0 < y[train].mean() < 1 else 0.5
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    for _ in range(epochs):
        rng.shuffle(train)
        for i in range(0, len(train), BATCH):
            part = train[i:i + BATCH]
            net.train_on(*_joined([texts[j] for j in part]), y[part], weight[part])
    tables = net.tables()
    logit = np.concatenate([net.logits(tables, *_joined(texts[i:i + 256])) for i in range(0, len(texts), 256)])
    langs = sorted({r[1] for r in rows if r[1] is not None})
    hist = np.stack([np.frombuffer(r[3], np.int32) for r in rows]).astype(np.float64)
    of = np.array([langs.index(r[1]) if r[1] is not None else -1 for r in rows])
    prior = np.stack([hist[of == k].sum(0) + 0.5 for k in range(len(langs))]) if langs else np.ones((1, 256))
    model = {"remap": remap, "p": net.p, "langs": np.log(prior / prior.sum(1, keepdims=True))}
    # one threshold for all languages; ``calibrated`` gives each its own
    counts = Counter((0, *x) for x in zip(_step(logit[aside]).tolist(), y[aside].astype(int).tolist(), strict=True))
    model["thresholds"] = np.repeat(thresholds(counts, negatives, 1), len(model["langs"]))
    model["used"] = [(r[4], int(r[0])) for r, a in zip(rows, aside, strict=True) if not a]
    return model


def calibrated(model: dict | None, docs: DataFrame, labels: DataFrame) -> dict | None:
    """The model with the threshold of each guessed language from all labelled
    training rows that it wasn't fitted on."""
    if model is None:
        return None
    spark = docs.sparkSession
    prepared(spark)
    used = F.broadcast(spark.createDataFrame([(i,) for i, _ in model["used"]], "used string"))
    rest = saved(training_labels(labels).join(used, F.col("doc_id").cast("string") == F.col("used"), "left_anti"))
    shared = spark.sparkContext.broadcast({k: v for k, v in model.items() if k != "used"})
    rows = (docs.select("doc_id", "text").join(sized(rest, 32), "doc_id").select("toxic", "text")
            .mapInArrow(_steps(shared), "toxic int, guess int, step int")
            .groupBy("guess", "step", "toxic").count().collect())
    counts = {(r["guess"], r["step"], r["toxic"]): r["count"] for r in rows}
    # rows of the fit are missing here: each of a class stands for as many as it has
    n = [sum(c for (_, _, t), c in counts.items() if t == k) for k in (0, 1)]
    fitted = [sum(t == k for _, t in model["used"]) for k in (0, 1)]
    stands = [(a + b) / max(a, 1) for a, b in zip(n, fitted, strict=True)]
    return {**model, "thresholds": thresholds(counts, stands[0] / max(stands[1], 1e-9), len(model["langs"]))}


class _Ids(dict):
    """Word -> embedding row, remembered up to a bound."""

    def __init__(self, remap):
        super().__init__()
        self.remap = remap

    def __missing__(self, word):
        if len(self) > 500_000:
            self.clear()
        self[word] = row = int(self.remap[bucket(word)])
        return row


def _logits(shared):
    """Function: logits and guessed languages of the texts of a batch."""
    model = shared.value
    net = Net.__new__(Net)
    net.p = model["p"]
    tables, ids = net.tables(), _Ids(model["remap"])

    def of(b):
        texts = ["" if t is None else t for t in b.column("text").to_pylist()]
        rows = [np.array([ids[w] for w in words_of(t)], np.int32) for t in texts]
        hist = np.stack([np.bincount(np.frombuffer(t.encode(), np.uint8), minlength=256) for t in texts]) \
            if texts else np.zeros((0, 256))
        tops = np.full((len(texts), len(WIDTHS), FILTERS), -np.inf, np.float32)
        for block in _segments(rows):
            found, _ = Net.pooled(tables, *_joined([part for _, part in block]))
            np.maximum.at(tops, np.array([i for i, _ in block]), np.stack(found, 1))
        return net.of_tops(tops), (hist @ model["langs"].T).argmax(1)
    return of


def _steps(shared):
    def run(batches):
        of = _logits(shared)
        for b in batches:
            logit, guess = of(b)
            yield pa.RecordBatch.from_arrays(
                [b.column("toxic"), pa.array(guess.astype(np.int32)), pa.array(_step(logit))],
                ["toxic", "guess", "step"])
    return run


def _score(shared):
    def run(batches):
        of = _logits(shared)
        for b in batches:
            logit, guess = of(b)
            logit = logit - shared.value["thresholds"][guess]
            score_ = 1 / (1 + np.exp(-np.clip(logit.astype(np.float64), -50, 50)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(score_, pa.float64())], ["doc_id", "score"])
    return run


def score(docs: DataFrame, model: dict | None) -> DataFrame:
    """doc_id, score for every row of ``docs``."""
    prepared(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if model is None:
        return rows.select("doc_id", F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast({k: v for k, v in model.items() if k != "used"})
    return rows.mapInArrow(_score(shared), "doc_id long, score double")


@query("op7_toxicity_cnn")
def op7_toxicity_cnn(spark, sf_dir):
    """Toxicity of every document, learned from the labels not held out."""
    prepared(spark)
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = calibrated(fit(*sample(docs, labels)), docs, labels)
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score",
                                     (F.col("score") >= 0.5).cast("int").alias("predicted"))
