import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuslens.operators import bootstrap, collocate


def test_weights_are_poisson(spark):
    rows = spark.range(2000)
    hashes, weights = bootstrap._weights("id", 40, 1)
    got = rows.withColumn("_hashes", hashes).select(F.explode(weights).alias("w")).groupBy("w").count().collect()
    share = {r.w: r["count"] / 80_000 for r in got}
    for k in range(4):
        assert share[k] == pytest.approx(math.exp(-1) / math.factorial(k), abs=0.006)


def test_band_holds_the_standard_error(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(10, 3, 900)
    rows = [(i, "a", float(v)) for i, v in enumerate(x)] + [(1000, "one", 4.0), (1001, "none", None)]
    df = spark.createDataFrame(rows, "id long, g string, v double").repartition(5)
    got = {r.g: r for r in bootstrap.confidence_band(df, "id", ["g"], "v").collect()}
    assert set(got) == {"a", "one"} and got["a"].n == 900
    half = 1.96 * x.std() / math.sqrt(len(x))
    assert got["a"].mean == pytest.approx(x.mean())
    assert got["a"].high - got["a"].low == pytest.approx(2 * half, rel=0.25) and got["a"].low < x.mean() < got["a"].high
    assert (got["one"].low, got["one"].high) == (4.0, 4.0)
    again = {r.g: r for r in bootstrap.confidence_band(df.repartition(2), "id", ["g"], "v").collect()}
    assert again["a"].low == pytest.approx(got["a"].low) and again["a"].high == pytest.approx(got["a"].high)


def _brute(texts):
    words, pairs = Counter(), Counter()
    for t in texts:
        w = (t or "").lower().split()
        words.update(w)
        pairs.update(zip(w, w[1:]))
    total = sum(words.values())

    def like(k, n, p):
        return k * math.log(max(p, 1e-10)) + (n - k) * math.log(max(1 - p, 1e-10))

    out = {}
    for (a, b), k in pairs.items():
        p, p1 = words[b] / total, k / words[a]
        p2 = (words[b] - k) / (total - words[a]) if total > words[a] else 0.0
        rest = (words[b] - k, total - words[a])
        out[a, b] = 2 * (like(k, words[a], p1) + like(*rest, p2) - like(k, words[a], p) - like(*rest, p))
    return words, pairs, out


def test_pairs_and_what_is_left_of_the_words(spark):
    texts = ["New York is big"] * 30 + ["a big new house is in York"] * 3 + ["is it a house"] * 20 + ["bye bye", None, "", "x"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    words, pairs, score = _brute(texts)
    w, p = collocate.word_counts(docs, "text"), collocate.pair_counts(docs, "text")
    got = {(r.w1, r.w2): r for r in collocate.pair_scores(w, p).collect()}
    assert {k: r.n for k, r in got.items()} == dict(pairs)
    for k, r in got.items():
        assert r.score == pytest.approx(score[k], abs=1e-4)
    chosen = {k for k, s in score.items() if s > collocate.PAIR_SCORE}
    assert ("new", "york") in chosen and ("is", "in") not in chosen
    left = Counter(words)
    for a, b in chosen:
        left[a] -= pairs[a, b]
        left[b] -= pairs[a, b]
    want = {(k, n, False) for k, n in left.items() if n > 0} | {(" ".join(k), pairs[k], True) for k in chosen}
    assert {(r.word, r["count"], r.pair) for r in collocate.frequencies(docs, "text").collect()} == want
    assert collocate.frequencies(docs.limit(0), "text").collect() == []
