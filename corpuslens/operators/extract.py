"""Extract-and-rank: candidate sentences (TextRank) ranked by cosine to their
document, cut to several summary lengths from ONE ranking.

Shape of the job: document frequencies of all terms -> weights of the most
frequent terms, sent to the tasks; those of each document's rare terms, if
there are any, regrouped by document and joined with the texts -> in each row:
split, score (numpy, Arrow batches), sort, slice to every length.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.functions import segment, text
from corpuslens.functions import wordruns as W
from corpuslens.operators import textrank, vectors
from corpuslens.options import CANDIDATE_LIMIT, SUMMARY_LENGTHS, Variant
from corpuslens.session import bounded_batches

# Fixed value: similarity digits kept before ranking, so ties break on the
# sentence text identically in every engine despite summation order.
COSINE_DIGITS = 9


def ranking_input(article_col: str, variant: Variant):
    """The text whose sentences are ranked: article or body, maybe cleaned."""
    src = text.body_of(article_col) if variant.part == "body" else F.col(article_col)
    return text.preprocess_text(src) if variant.cleaned else src


def guarded_sentences(text_col: str):
    """Sentence array of a text; blank or null text gives an empty array."""
    return F.when(text.is_blank(text_col), F.array().cast("array<string>")).otherwise(
        segment.sentences(text_col))


def sentence_rows(docs: DataFrame, key: str, text_col: str) -> DataFrame:
    """(key, pos, sentence) with 1-based positions; blank texts give none."""
    ex = docs.select(key, F.posexplode(guarded_sentences(text_col)).alias("pos", "sentence"))
    return ex.select(key, (F.col("pos") + 1).alias("pos"), "sentence")


def document_terms(docs: DataFrame, key: str, text_col: str, weights=None) -> DataFrame:
    """(key, term, tf, idf, w) of every document; ``weights`` is the idf table
    and what ``sent_idf`` made of it, found if not given.

    Words never cross a sentence boundary, so the document's counts are the
    counts of its whole text (blank texts have no words either way).
    """
    if weights is None:
        idf = vectors.idf_table(docs, key, text_col)
        weights = idf, *vectors.sent_idf(idf)
    return vectors.document_weights(docs, key, text_col, *weights).withColumn("w", F.col("tf") * F.col("idf"))


def _cosines(found: np.ndarray, n_words: np.ndarray, doc: np.ndarray, terms: np.ndarray, idf: np.ndarray, docs: int,
             sent: vectors.SentWeights) -> np.ndarray:
    """TF-IDF cosine of every sentence to its document: ``n_words`` of the
    words ``found`` are a sentence's, ``doc`` is its document; ``terms`` have
    ``idf``, the others what ``sent`` has (words and terms are numbers)."""
    code, names = W.numbered(pa.array(np.concatenate([found, terms])))
    weight = sent.find(names.to_numpy())[1]
    weight[code[len(found):]] = idf
    code = code[:len(found)]
    at = np.repeat(np.arange(len(n_words)), n_words)
    of, whole = W.numbered(pa.array(W.joined(doc[at], code)))
    whose, term = W.parts(whole.to_numpy())
    total = np.bincount(of, minlength=len(term)) * weight[term]
    dot = np.bincount(at, weight[code] * total[of], len(n_words))
    pair, tf = W.counted(W.joined(at, of))
    at, of = W.parts(pair)
    norm = np.sqrt(np.bincount(at, (tf * weight[term[of]]) ** 2, len(n_words)))
    length = np.sqrt(np.bincount(whose, total * total, docs))
    with np.errstate(invalid="ignore", divide="ignore"):
        return dot / (norm * length[doc])


def _flat(lists: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Items of all lists in a row, and how many each has (null: none)."""
    n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return lists.flatten(), n


def _block_scores(sents: pa.Array, terms: pa.Array, idf: pa.Array, longer: np.ndarray, keyed: np.ndarray, limit: int,
                  sent: vectors.SentWeights) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cosines of all sentences of some documents; the kept positions of the
    longer ones in a row, and how many each document has."""
    flat, n_sents = _flat(sents)
    points, sizes = W.code_points(flat)
    doc = np.repeat(np.arange(len(sents)), n_sents)
    found, n_words = W.word_numbers(points, sizes, W.latin(), sent.seed)
    rare = W.word_numbers(*W.code_points(_flat(terms)[0]), W.latin(), sent.seed)[0]
    cos = _cosines(found, n_words, doc, rare, _flat(idf)[0].to_numpy(zero_copy_only=False), len(sents), sent)
    cos[~keyed[doc]] = np.nan  # a document without a key has no weights
    kept, n_kept = np.zeros(0, np.int64), np.zeros(len(sents), np.int64)
    if longer.any():
        some = longer[doc]
        tr, n_tr, _ = W.words(points[np.repeat(some, sizes)], sizes[some], W.letters(), textrank.LEAST_LETTERS)
        kept, n_kept[longer] = textrank.kept_positions(W.numbered(tr)[0], n_tr, n_sents[longer], limit)
    return cos, kept, n_kept


def _scorer(limit: int, sent):
    """Column function over lower-cased sentences: per document, the cosines
    of its sentences and, where it is longer, the positions TextRank keeps."""
    @F.arrow_udf("struct<cos:array<double>,keep:array<int>>")
    def score(sents: pa.Array, terms: pa.Array, idf: pa.Array, longer: pa.Array, keyed: pa.Array) -> pa.Array:
        flat, n_sents = _flat(sents)
        size = np.concatenate([[0], np.cumsum(pc.fill_null(pc.utf8_length(flat), 0).to_numpy(zero_copy_only=False))])
        at = np.concatenate([[0], np.cumsum(n_sents)])
        marked, named = (pc.fill_null(x, False).to_numpy(zero_copy_only=False).astype(bool) for x in (longer, keyed))
        got = [(np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for i, j in W.blocks(np.diff(size[at]).astype(np.int64)):
            got.append(_block_scores(*(x.slice(i, j - i) for x in (sents, terms, idf)), marked[i:j], named[i:j], limit, sent.value))
        cos, kept, n_kept = (np.concatenate(x) for x in zip(*got))
        lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(cos))
        keep = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n_kept)]), pa.int32()), pa.array(kept, pa.int32()),
                                        mask=pa.array(~marked))
        return pa.StructArray.from_arrays([lists, keep], ["cos", "keep"])
    return score


def scored_documents(docs: DataFrame, key: str, text_col: str, limit: int | None, carry: Sequence[str] = ()) -> DataFrame:
    """(key, carry..., sents, cos, keep): sentences, their cosines to the
    document (null without words), and the positions TextRank keeps (null: all).

    The weights of frequent terms are sent to the tasks.  Only if there are
    rare ones, a shuffle brings a document's text together with theirs;
    everything about its sentences then happens in its row.
    """
    bounded_batches(docs.sparkSession)
    idf = vectors.idf_table(docs, key, text_col)
    sent, every = vectors.sent_idf(idf)
    rows = docs.select(key, text_col, *[c for c in carry if c != text_col])
    if every:
        rows = rows.withColumn("_weights", F.lit(None).cast("array<struct<term:string,idf:double>>"))
    else:
        weights = (vectors.distinct_terms(docs, key, text_col, sent).join(idf, "term")
                   .groupBy(key).agg(F.collect_list(F.struct("term", "idf")).alias("_weights")))
        rows = rows.join(weights, key, "left")
    rows = rows.withColumn("sents", guarded_sentences(text_col))
    # only documents beyond the limit need a word graph
    longer = F.lit(False) if limit is None else F.size("sents") > limit
    no_terms = F.array().cast("array<string>"), F.array().cast("array<double>")
    scored = rows.withColumn("_s", _scorer(limit or 0, sent)(
        F.transform("sents", lambda s: F.lower(s)), F.coalesce("_weights.term", no_terms[0]),
        F.coalesce("_weights.idf", no_terms[1]), longer, F.col(key).isNotNull()))
    cos = F.transform("_s.cos", lambda c: F.when(~F.isnan(c), c))
    return scored.select(key, *carry, "sents", cos.alias("cos"), F.col("_s.keep").alias("keep"))


def ranked_documents(docs: DataFrame, key: str, text_col: str, limit: int | None = CANDIDATE_LIMIT,
                     carry: Sequence[str] = ()) -> DataFrame:
    """(key, carry..., ranked: array<struct<c9, sentence, negpos, cosine>>), best first.

    The order -- rounded cosine desc, sentence text desc, position asc -- is a
    sort of each document's own sentences, bounded by its length.
    """
    scored = scored_documents(docs, key, text_col, limit, carry)

    def item(s, i):
        c = F.get("cos", i)
        return F.struct(F.round(c, COSINE_DIGITS).alias("c9"), s.alias("sentence"), (-(i + 1)).alias("negpos"),
                        c.alias("cosine"))

    items = F.transform("sents", item)
    kept = F.when(F.col("keep").isNull(), items).otherwise(
        F.filter(items, lambda x: F.array_contains(F.col("keep"), -x.getField("negpos"))))
    return scored.select(key, *carry, F.sort_array(kept, asc=False).alias("ranked"))


def ranked_sentences(docs: DataFrame, key: str, text_col: str, limit: int | None = CANDIDATE_LIMIT) -> DataFrame:
    """(key, rank, pos, sentence, cosine) rows of the ranking."""
    r = ranked_documents(docs, key, text_col, limit)
    ex = r.select(key, F.posexplode("ranked").alias("_i", "_x"))
    return ex.select(key, (F.col("_i") + 1).alias("rank"), (-F.col("_x.negpos")).alias("pos"),
                     F.col("_x.sentence").alias("sentence"), F.col("_x.cosine").alias("cosine"))


def summary_of(ranked_col: str, n: int, abstract_col: str | None = None):
    """First ``n`` ranked sentences joined by newlines; maybe after the abstract."""
    s = F.array_join(F.slice(ranked_col, 1, n), "\n")
    return text.prepend_abstract(abstract_col, s) if abstract_col else s


def extract_wide(corpus: DataFrame, variant: Variant, key: str = "doc_id",
                 lengths: Sequence[int] = SUMMARY_LENGTHS, carry: Sequence[str] = ()) -> DataFrame:
    """(key, article, summary, carry..., extracted_summary_<n> for each n): one
    ranking, every length sliced from it in the same projection."""
    kept = ["article", "summary", *carry]
    inp = corpus.select(key, ranking_input("article", variant).alias("_input"), *kept)
    r = ranked_documents(inp, key, "_input", variant.candidate_limit, carry=kept)
    lists = F.transform("ranked", lambda x: x.getField("sentence"))
    out = r.select(key, *kept, text.abstract_of("article").alias("_abstract"), lists.alias("_r"))
    abstract = "_abstract" if variant.abstract_first else None
    return out.select(key, *kept,
                      *[summary_of("_r", n, abstract).alias(f"extracted_summary_{n}") for n in lengths])


def extract_long(wide: DataFrame, key: str = "doc_id", lengths: Sequence[int] = SUMMARY_LENGTHS) -> DataFrame:
    """(key, article, summary, ..., n_sentences, transformed): one row per
    document and length, with all other columns of ``wide``."""
    items = F.array(*[F.struct(F.lit(n).alias("n_sentences"), F.col(f"extracted_summary_{n}").alias("transformed"))
                      for n in lengths])
    kept = [c for c in wide.columns if not c.startswith("extracted_summary_")]
    return wide.select(*kept, F.explode(items).alias("_x")).select(*kept, "_x.n_sentences", "_x.transformed")


def transform(corpus: DataFrame, variant: Variant, key: str = "doc_id") -> DataFrame:
    """Variants that aren't ranked: (key, article, summary, transformed)."""
    if variant.ranked:
        raise ValueError("ranked variants are made by extract_wide")
    t = text.abstract_of("article") if variant.part == "abstract" else F.col("article")
    if variant.cleaned:
        t = text.preprocess_text(t)
    return corpus.select(key, "article", "summary", t.alias("transformed"))
