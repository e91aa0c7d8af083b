"""N-gram overlap metrics: ROUGE-N and corpus BLEU (published formulas).

Both start from ``ngram_overlap``: for every pair (generated, reference) and
every n, the clipped match count ``sum_g min(c_gen(g), c_ref(g))`` and the
n-gram totals of each side.  Both texts of a pair are in one row, so the
counting happens in the row (Arrow batches) and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.functions import wordruns as W
from corpuslens.operators.normalize import row_mean
from corpuslens.session import bounded_batches


def _block_counts(generated: pa.Array, reference: pa.Array, sizes: np.ndarray, chain: np.ndarray, ns: Sequence[int],
                  known: pa.Array | None) -> dict[str, np.ndarray]:
    """Counts of every row of some chains of lower-cased texts.

    ``generated`` and ``reference`` have one row a chain.  The rows, in order,
    are the first ``sizes`` code points of the text of their ``chain``, the
    last one all of it, and a new line follows where a row stops.  So no word
    and no sentence is in two parts, and what a part has is added up."""
    rows = len(sizes)
    first = np.diff(chain, prepend=-1) > 0
    part = sizes - np.where(first, 0, np.roll(sizes, 1)) + np.append(first[1:], True)[:rows]
    points, _ = W.code_points(generated)
    gw, n_gen, long = W.words(points, part, W.latin())
    rw, n_ref, _ = W.words(*W.code_points(reference), W.latin())
    code, names = W.numbered(pa.concat_arrays([gw, rw]))
    code, v = (code[:len(gw)], code[len(gw):]), max(len(names), 1)
    of_word = np.repeat(np.arange(rows), n_gen)

    def added(found):
        upto = np.cumsum(found)
        return (upto - (upto - found)[first][chain]).astype(np.int64)

    n_whole = np.bincount(chain, n_gen, len(n_ref)).astype(np.int64)
    left = [np.repeat(np.cumsum(n), n) - np.arange(n.sum()) for n in (n_whole, n_ref)]  # words to the end of the text
    out = {"n_words": added(n_gen), "n_ref": n_ref[chain], "n_vowels": added(W.vowel_groups(points, part)),
           "n_sents": added(W.sentences(points, part)), "n_letters": added(np.bincount(of_word, long, rows))}
    if known is not None:
        strange = ~pc.is_in(names, value_set=known).to_numpy(zero_copy_only=False).astype(bool)
        out["missing"] = added(np.bincount(of_word, strange[code[0]], rows))
    # a match of n words is one of n - 1 words and one more, so only the
    # places of shorter matches are looked at; numbers of grams are per chain
    place = [np.arange(len(c)) for c in code]
    gram = [chain[of_word], np.repeat(np.arange(len(n_ref)), n_ref)]
    for n in range(1, max(ns) + 1):
        for side in (0, 1):
            keep = left[side][place[side]] >= n
            place[side], gram[side] = place[side][keep], gram[side][keep]
        key = [gram[i] * v + code[i][place[i] + n - 1] for i in (0, 1)]
        grams, gram[1], c_ref = np.unique(key[1], return_inverse=True, return_counts=True)
        at = np.minimum(np.searchsorted(grams, key[0]), max(len(grams) - 1, 0))
        met = grams[at] == key[0] if len(grams) else np.zeros(len(at), bool)
        place[0], gram[0] = place[0][met], at[met]
        # of a gram's places as many count as the reference has, the first ones
        order = np.argsort(gram[0], kind="stable")
        c_gen = np.bincount(gram[0], minlength=len(grams))
        nth = np.arange(len(order)) - np.repeat(np.cumsum(c_gen) - c_gen, c_gen)
        clipped = order[nth < np.repeat(c_ref, c_gen)]
        out[f"m{n}"] = added(np.bincount(of_word[place[0][clipped] + n - 1], minlength=rows))
    return out


def _differs(texts: pa.Array) -> np.ndarray:
    """Which texts are not the one before them: summaries of several lengths
    are one text where a document is short, and are counted once."""
    out = np.ones(len(texts), bool)
    out[1:] = pc.fill_null(pc.not_equal(texts.slice(1), texts.slice(0, max(len(texts) - 1, 0))), True).to_numpy(zero_copy_only=False)
    return out


def _goes_on(generated: pa.Array, reference: pa.Array) -> np.ndarray:
    """Which texts are the one before them, a new line and more, with the same
    reference: a summary begins with the shorter ones of the document."""
    out = np.zeros(len(generated), bool)
    for i in np.flatnonzero(~_differs(reference)):
        one, two = (generated[int(k)].as_buffer() or pa.py_buffer(b"") for k in (i - 1, i))
        out[i] = (one.size < two.size and two.slice(one.size, 1).to_pybytes() == b"\n"
                  and two.slice(0, one.size).equals(one))
    return out


def pair_counts(ns: Sequence[int], listed=None):
    """Column function over two lower-cased texts: clipped matches for each n,
    words of both, vowel groups, sentences and letters of the generated one,
    and its words that are missing from ``listed`` (a broadcast set)."""
    names = ["n_words", "n_ref", "n_vowels", "n_sents", "n_letters", "missing"]

    @F.arrow_udf("struct<matched:array<bigint>," + ",".join(f"{c}:bigint" for c in names) + ">")
    def count(generated: pa.Array, reference: pa.Array) -> pa.Array:
        known = pa.array(list(listed.value), pa.large_string()) if listed is not None else None
        new = _differs(generated) | _differs(reference)
        generated, reference = (c.filter(pa.array(new)) for c in (generated, reference))
        size = [pc.fill_null(pc.utf8_length(c), 0).to_numpy(zero_copy_only=False).astype(np.int64) for c in (generated, reference)]
        # texts that go on are counted once, with the places where they stop
        chain = np.cumsum(~_goes_on(generated, reference)) - 1
        last = np.flatnonzero(np.diff(chain, append=len(chain)))
        stop = last + 1
        start = np.concatenate([[0], stop[:-1]]).astype(np.int64)
        whole = generated.take(pa.array(last)), reference.take(pa.array(last))
        parts = [_block_counts(*(c.slice(i, j - i) for c in whole), size[0][start[i]:stop[j - 1]],
                               chain[start[i]:stop[j - 1]] - i, ns, known)
                 for i, j in W.blocks((size[0] + size[1])[last])]
        got = {c: np.concatenate([p[c] for p in parts]) if parts else np.zeros(0, np.int64)
               for c in [*names, *[f"m{n}" for n in ns]] if c != "missing" or known is not None}
        matched = np.stack([got[f"m{n}"] for n in ns], 1)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, matched.size + 1, len(ns)), pa.int32()), pa.array(matched.ravel()))
        plain = [pa.array(got[c]) if c in got else pa.nulls(len(lists), pa.int64()) for c in names]
        out = pa.StructArray.from_arrays([lists, *plain], ["matched", *names])
        return out.take(pa.array(np.cumsum(new) - 1))
    return count


def lowered(text_col) -> Column:
    return F.lower(F.coalesce(F.col(text_col), F.lit("")))


def ngram_total(n_words, n: int) -> Column:
    return F.greatest(F.col(n_words) - F.lit(n - 1), F.lit(0)).cast("bigint")


def ngram_overlap(pairs: DataFrame, key: str, gen_col: str, ref_col: str,
                  ns: Sequence[int] = (1, 2), carry: Sequence[str] = ()) -> DataFrame:
    """(key, carry..., n, matched, gen_total, ref_total) per pair and n in ``ns``."""
    bounded_batches(pairs.sparkSession)
    base = pairs.select(key, *carry, pair_counts(ns)(lowered(gen_col), lowered(ref_col)).alias("_m"))
    per_n = [F.struct(F.lit(n).alias("n"), F.get("_m.matched", F.lit(i)).alias("matched"),
                      ngram_total("_m.n_words", n).alias("gen_total"), ngram_total("_m.n_ref", n).alias("ref_total"))
             for i, n in enumerate(ns)]
    return base.select(key, *carry, F.explode(F.array(*per_n)).alias("_x")).select(key, *carry, "_x.*")


def rouge_n(pairs: DataFrame, key: str, gen_col: str, ref_col: str,
            ns: Sequence[int] = (1, 2)) -> DataFrame:
    """Per pair and n: ROUGE-N precision, recall and F1 (null when undefined)."""
    ov = ngram_overlap(pairs, key, gen_col, ref_col, ns)
    m = F.col("matched").cast("double")
    return ov.select(
        key, "n",
        F.try_divide(m, F.col("gen_total").cast("double")).alias("precision"),
        F.try_divide(m, F.col("ref_total").cast("double")).alias("recall"),
        F.try_divide(2.0 * m, (F.col("gen_total") + F.col("ref_total")).cast("double")).alias("f1"),
    )


def rouge_wide(pairs: DataFrame, key: str, gen_col: str, ref_col: str) -> DataFrame:
    """Per pair: ``rouge1``, ``rouge2`` F1 and ``rouge`` = their (null-skipping) mean."""
    r = rouge_n(pairs, key, gen_col, ref_col, (1, 2))
    wide = r.groupBy(key).agg(F.max(F.when(F.col("n") == 1, F.col("f1"))).alias("rouge1"),
                              F.max(F.when(F.col("n") == 2, F.col("f1"))).alias("rouge2"))
    return wide.withColumn("rouge", row_mean(["rouge1", "rouge2"]))


def bleu_from_overlap(ov: DataFrame, group_cols: Sequence[str], max_n: int = 4) -> DataFrame:
    """Corpus BLEU-``max_n`` (x100) per group from per-pair overlap rows.

    ``ov`` must carry the group columns, ``n``, ``matched``, ``gen_total`` and
    ``ref_total``.  Lengths are the unigram totals.  BP = 1 if c > r else
    exp(1 - r/c); a zero precision gives 0; no generated words gives null.
    """
    sums = (ov.groupBy(*group_cols)
            .agg(*[F.sum(F.when(F.col("n") == n, F.col("matched"))).alias(f"m{n}") for n in range(1, max_n + 1)],
                 *[F.sum(F.when(F.col("n") == n, F.col("gen_total"))).alias(f"t{n}") for n in range(1, max_n + 1)],
                 F.sum(F.when(F.col("n") == 1, F.col("ref_total"))).alias("r_len")))
    return sums.select(*group_cols, bleu_of_sums(max_n).alias("bleu"))


def bleu_of_sums(max_n: int = 4) -> Column:
    """BLEU from the summed columns m1.., t1.. and r_len."""
    c, r = F.col("t1").cast("double"), F.col("r_len").cast("double")
    bp = F.when(c > r, F.lit(1.0)).otherwise(F.exp(F.lit(1.0) - F.try_divide(r, c)))
    log_p = [F.ln(F.try_divide(F.col(f"m{n}").cast("double"), F.col(f"t{n}").cast("double")))
             for n in range(1, max_n + 1)]
    any_zero = F.greatest(*[(F.coalesce(F.col(f"m{n}"), F.lit(0)) == 0).cast("int")
                            for n in range(1, max_n + 1)]) == 1
    return (F.when(c.isNull() | (c == 0), F.lit(None).cast("double")).when(any_zero, F.lit(0.0))
            .otherwise(F.lit(100.0) * bp * F.exp(sum(log_p, F.lit(0.0)) / F.lit(float(max_n)))))
