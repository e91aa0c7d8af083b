r"""Sentence segmentation learned from the corpus (T1, learned form).

A pattern that cuts behind every period also cuts behind abbreviations.  Here
the corpus itself tells which words are abbreviations and which words start
sentences, without labels (Kiss and Strunk, "Unsupervised Multilingual
Sentence Boundary Detection", 2006):

* a word is an abbreviation if it stands before a period far more often than
  words do on average (log-likelihood ratio against p = 0.99), weighted by
  exp(-letters), by its inner periods, and down for each time it stands
  without a period: score >= ABBREVIATION;
* a word starts sentences if it follows a sure boundary more often than it
  occurs at all (log-likelihood ratio >= STARTER).

A text is cut behind ``!`` and ``?``, at line breaks, and behind a period
unless the word before is an abbreviation or an initial (then only if the next
word starts in upper case and is a sentence starter) or a number (then only
before upper case).  A period inside a word or number, as in 3.14, has no
white space behind it and never cuts.

Statistics are counts per word, taken from all texts in one pass and added up
in the worker; a text is never shuffled for them.  The learned lists are sent
to the tasks, and a text is cut in its row.  Only if a list is too long for
that, a text's own abbreviations and starters are joined with it.

The patterns are applied to the distinct tokens of some texts at a time.
``$`` also stands before a last line mark (``LINE_MARK``), as in Java.

Defined results: null and blank texts have no sentence; white space inside a
sentence becomes one space; a corpus without periods has no abbreviation.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.functions import wordruns
from corpuslens.session import bounded_batches, cut_lineage

# The published thresholds and the assumed share of periods
# behind an abbreviation.
ABBREVIATION = 0.3
STARTER = 30.0
BEHIND_ABBREVIATION = 0.99

# Tokens (a line break is one), marks around a word, words that
# may be abbreviations, and how a token that ends a sentence looks.
TOKEN = r"[^ \t\n\x0B\f\r]+|\n"
OPENING, CLOSING = r"^[(\[{\"']+", r"[)\]}\"',;:]+$"
WORD = r"^\p{L}++(?:\.\p{L}++)*+$"
NUMBER = r"^[0-9]+$"
EXCLAIMED = r"[!?]$"
UPPER = r"^[(\[{\"']*\p{Lu}"
#: digits that scores keep, so that thresholds decide alike in every engine
DIGITS = 6
#: a list of words is sent to every task up to this size
LIST_BYTES, BYTES_PER_WORD = 8 << 20, 100
#: bytes of text that are worked on together, counts that a worker holds
TEXT_AT_ONCE, COUNTS_HELD = 1 << 20, 1 << 19
#: line marks that may be part of a token
LINE_MARK = r"([\x{85}\x{2028}\x{2029}]?)$"


def tokens(text_col: str) -> Column:
    return F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(TOKEN), F.lit(0))


def _core(token: Column) -> Column:
    return F.lower(F.regexp_replace(F.regexp_replace(token, OPENING, ""), CLOSING, ""))


def token_rows(docs: DataFrame, key: str, text_col: str) -> DataFrame:
    """key, token, core (bare, lower case), base (without its last period),
    dotted, and next, the token behind it; line breaks only as ``next``."""
    t = docs.select(key, tokens(text_col).alias("_t"))
    pairs = F.transform("_t", lambda x, i: F.struct(x.alias("token"), F.get("_t", i + 1).alias("next")))
    rows = t.select(key, F.inline(pairs)).where(F.col("token") != "\n").withColumn("core", _core(F.col("token")))
    return rows.withColumns({"dotted": F.col("core").endswith("."),
                             "base": F.regexp_replace("core", r"\.$", "")})


class _Tokens(NamedTuple):
    """All tokens of some texts, in order."""
    raw: np.ndarray  # the texts' bytes, white space behind each
    first: np.ndarray  # where tokens start and stop in them
    stop: np.ndarray
    of: np.ndarray  # whose token it is
    code: np.ndarray  # which of ``kinds`` it is
    kinds: pa.Array  # the distinct tokens
    is_break: np.ndarray  # whether it is a line break

    def following(self) -> np.ndarray:
        """The code of the next token of the same text, one behind the last kind if there is none."""
        out = np.full(len(self.code), len(self.kinds))
        same = self.of[1:] == self.of[:-1]
        out[:-1][same] = self.code[1:][same]
        return out


_SPACE = np.zeros(256, bool)
_SPACE[[ord(c) for c in " \t\n\x0b\f\r"]] = True


def _found(texts: pa.Array) -> _Tokens:
    """What ``tokens`` finds, from the bytes of all texts together."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    ended = pc.binary_join_element_wise(texts, pa.scalar("", texts.type), pa.scalar(" ", texts.type))
    at = np.frombuffer(ended.buffers()[1], np.int64, len(ended) + 1, 8 * ended.offset)
    raw = np.frombuffer(ended.buffers()[2], np.uint8)[at[0]:at[-1]]
    space = _SPACE[raw]
    line = raw == ord("\n")
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    edge = np.concatenate([[0], edge]) if len(space) and not space[0] else edge
    starts = np.zeros(len(raw), bool)
    starts[edge[::2]] = True
    starts |= line
    first = np.flatnonzero(starts)
    is_break = line[first]
    stop = first + 1
    stop[~is_break] = edge[1::2]
    size = np.concatenate([[0], np.cumsum(stop - first)])
    names = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(size.astype(np.int64).tobytes()), pa.py_buffer(raw[~space | line].tobytes()))
    code, kinds = wordruns.numbered(names)
    of = np.repeat(np.arange(len(texts)), wordruns.per_text(first, np.diff(at)))
    return _Tokens(raw, first, stop, of, code, kinds, is_break)


def _lower(words: pa.Array) -> pa.Array:
    plain, low = pc.string_is_ascii(words), pc.ascii_lower(words)
    if pc.all(plain).as_py():
        return low
    other = pc.invert(plain)
    return pc.replace_with_mask(low, other, pa.array([w.lower() for w in words.filter(other).to_pylist()], low.type))


def _matches(words: pa.Array, pattern: str) -> np.ndarray:
    pattern = pattern.replace("++", "+").replace("*+", "*")  # letters and periods don't overlap
    return pc.match_substring_regex(words, pattern.removesuffix("$") + LINE_MARK if pattern.endswith("$") else pattern).to_numpy(zero_copy_only=False)


def _cores(kinds: pa.Array) -> pa.Array:
    """``_core`` of distinct tokens."""
    bare = pc.replace_substring_regex(kinds, OPENING, "")
    return _lower(pc.replace_substring_regex(bare, CLOSING.removesuffix("$") + LINE_MARK, r"\1"))


def _bases(cores: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(cores, r"\." + LINE_MARK, r"\1")


def _block_counts(texts: pa.Array) -> pa.Table:
    """base, word, n_dotted, n_plain and n_sure of some texts."""
    t = _found(texts)
    core = _cores(t.kinds)
    bases, v = _bases(core), len(t.kinds)
    dotted, is_word, core_word = pc.ends_with(core, ".").to_numpy(zero_copy_only=False), _matches(bases, WORD), _matches(core, WORD)
    is_token = np.append(pc.not_equal(t.kinds, "\n").to_numpy(zero_copy_only=False), False)[:v]
    n = np.bincount(t.code, minlength=v)
    listed = np.flatnonzero(is_word & is_token)
    count, marked = n[listed], dotted[listed]
    # sure boundaries: an abbreviation may be behind those with a base
    based = dotted & is_word
    sure = (is_token & (based | _matches(t.kinds, EXCLAIMED)))[t.code]
    base, word = np.where(based[t.code[sure]], t.code[sure], v), t.following()[sure]
    word = np.where(np.append(core_word, False)[word], word, v)
    pair, n_sure = wordruns.counted(wordruns.joined(base, word))
    base, word = wordruns.parts(pair)

    def named(names, code):
        return names.take(pa.array(code, mask=code == v))

    zeros, none = np.zeros(len(listed), np.int64), np.zeros(len(pair), np.int64)
    return pa.table([pa.concat_arrays([bases.take(pa.array(listed)), named(bases, base)]),
                     pa.concat_arrays([pa.nulls(len(listed), core.type), named(core, word)]),
                     np.concatenate([np.where(marked, count, 0), none]), np.concatenate([np.where(marked, 0, count), none]),
                     np.concatenate([zeros, n_sure])], ["base", "word", "n_dotted", "n_plain", "n_sure"])


def _summed(held: list[pa.Table]) -> pa.Table:
    sums = pa.concat_tables(held).group_by(["base", "word"], use_threads=False).aggregate([(c, "sum") for c in ("n_dotted", "n_plain", "n_sure")])
    return sums.rename_columns([c.removesuffix("_sum") for c in sums.column_names]).select(["base", "word", "n_dotted", "n_plain", "n_sure"])


def _batch_counts(batches):
    """Arrow function: texts -> their counts, added up as far as a worker holds them."""
    held, rows = [], 0

    def given(table):
        strings = [table.column(c).cast(pa.string()) for c in ("base", "word")]
        return pa.table([*strings, *table.columns[2:]], table.column_names).to_batches(10_000)

    for batch in batches:
        text = batch.column(0)
        for i, j in wordruns.blocks(pc.binary_length(text).to_numpy().astype(np.int64), TEXT_AT_ONCE):
            held.append(_block_counts(text.slice(i, j - i)))
            rows += len(held[-1])
            if rows > COUNTS_HELD:
                held = [_summed(held)]
                rows = len(held[0])
                if rows > COUNTS_HELD // 2:
                    yield from given(held[0])
                    held, rows = [], 0
    if rows:
        yield from given(_summed(held))


def token_counts(docs: DataFrame, key: str, text_col: str) -> DataFrame:
    """Counts of ``token_rows``, from one pass over the texts, written once:
    (base, null, n_dotted, n_plain, ...) of the words, and (base, word,
    ..., n_sure) of sure boundaries with the word behind them (null if it is
    none); base is null there unless the boundary is a word's period."""
    bounded_batches(docs.sparkSession)
    parts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("_t")).mapInArrow(
        _batch_counts, "base string, word string, n_dotted bigint, n_plain bigint, n_sure bigint")
    return cut_lineage(parts.groupBy("base", "word").agg(*[F.sum(c).alias(c) for c in ("n_dotted", "n_plain", "n_sure")]))


def _times_log(n, p) -> Column:
    """n * ln(p), 0 if n is 0."""
    return F.when(n == 0, 0.0).otherwise(n * F.log(p))


def abbreviation_scores(counts: DataFrame) -> DataFrame:
    """base, n_dotted, n_plain, score and abbreviation (boolean) of every
    word of ``token_counts`` that stands before a period."""
    counts = cut_lineage(counts.where("base is not null").groupBy("base").agg(F.sum("n_dotted").alias("n_dotted"),
                                                                              F.sum("n_plain").alias("n_plain")))
    total = counts.agg((F.sum("n_dotted") / F.sum(F.col("n_dotted") + F.col("n_plain"))).alias("p")).first()["p"]
    p = F.lit(min(total or 0.5, 1 - 1e-9))
    n, k = F.col("n_dotted") + F.col("n_plain"), F.col("n_dotted")
    ratio = 2 * (_times_log(k, F.lit(BEHIND_ABBREVIATION)) + _times_log(n - k, F.lit(1 - BEHIND_ABBREVIATION))
                 - _times_log(k, p) - _times_log(n - k, 1 - p))
    letters = F.length(F.replace(F.col("base"), F.lit("."), F.lit("")))
    periods = F.length("base") - letters + 1
    score = F.round(ratio * F.exp(-letters) * periods * F.pow(letters.cast("double"), -F.col("n_plain")), DIGITS)
    return (counts.where("n_dotted > 0").withColumn("score", score)
            .withColumn("abbreviation", F.col("score") >= ABBREVIATION))


def _listed(words: DataFrame) -> DataFrame:
    """A word list, sent to every task if its counted size allows."""
    words = cut_lineage(words)
    return F.broadcast(words) if words.count() * BYTES_PER_WORD <= LIST_BYTES else words


def starter_scores(counts: DataFrame, abbreviations: DataFrame) -> DataFrame:
    """word, n_starts, n_all, score and starter (boolean) of every word of
    ``token_counts`` that follows a sure boundary."""
    pairs = counts.where("n_sure > 0").join(abbreviations.select("base"), "base", "left_anti")
    kept = cut_lineage(pairs.groupBy("word").agg(F.sum("n_sure").alias("n_starts")))
    breaks = kept.agg(F.sum("n_starts")).first()[0] or 0
    starts = kept.where("word is not null")
    every = (counts.where("base is not null").groupBy(F.col("base").alias("word"))
             .agg(F.sum(F.col("n_dotted") + F.col("n_plain")).alias("n_all")))
    every = cut_lineage(every)
    total = every.agg(F.sum("n_all")).first()[0] or 0
    s, c, b, n = F.col("n_starts"), F.col("n_all"), F.lit(float(breaks)), F.lit(float(max(total, breaks + 1)))

    def likelihood(k, of, p):
        return _times_log(k, p) + _times_log(of - k, 1 - p)

    ratio = 2 * (likelihood(s, b, s / b) + likelihood(c - s, n - b, (c - s) / (n - b))
                 - likelihood(s, b, c / n) - likelihood(c - s, n - b, c / n))
    out = starts.join(every, "word").where("n_all >= n_starts").withColumn("score", F.round(ratio, DIGITS))
    return out.withColumn("starter", (F.col("score") >= STARTER) & (s / b > c / n))


def learned_lists(docs: DataFrame, key: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The corpus' abbreviations (base) and sentence starters (word)."""
    counts = token_counts(docs, key, text_col)
    known = _listed(abbreviation_scores(counts).where("abbreviation").select("base"))
    return known, _listed(starter_scores(counts, known).where("starter").select("word"))


def _short(words: DataFrame) -> pa.Array | None:
    """The words of a list, None if it is too long to be sent."""
    most = LIST_BYTES // BYTES_PER_WORD
    found = words.limit(most + 1).toArrow().column(0).combine_chunks()
    return found.cast(pa.large_string()) if len(found) <= most else None


def _block_sentences(texts: pa.Array, keyed: np.ndarray, abbreviations: pa.Array, starters: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The sentences of some texts, and how many each has."""
    t = _found(texts)
    core = _cores(t.kinds)
    bases, v = _bases(core), len(t.kinds)

    def of_next(mark):
        return np.append(mark, False)[t.following()]

    def among(words, known):
        return pc.is_in(words, value_set=known).to_numpy(zero_copy_only=False)

    known = keyed[t.of]  # a text without a key has no lists
    upper = of_next(_matches(t.kinds, UPPER))
    begins = upper & of_next(among(core, starters)) & known
    held = _matches(bases, r"^\p{L}$")[t.code] | (among(bases, abbreviations)[t.code] & known)
    sure = (_matches(t.kinds, EXCLAIMED) | _matches(core, EXCLAIMED))[t.code]
    dotted = pc.ends_with(core, ".").to_numpy(zero_copy_only=False)[t.code]
    rest = np.where(_matches(bases, NUMBER)[t.code], upper, np.where(held, begins, True))
    ends = t.is_break | np.where(sure, True, dotted & rest)
    # a sentence starts at the first word of a text and behind an end
    starts = np.ones(len(ends), bool)
    starts[1:] = ends[:-1] | (t.of[1:] != t.of[:-1])
    words = np.flatnonzero(~t.is_break)
    opening = starts[words]
    # one space behind every word but the last of a sentence
    last = np.append(opening[1:], True)[:len(words)]
    out, kept = t.raw.copy(), ~_SPACE[t.raw]
    between = t.stop[words][~last]
    out[between], kept[between] = ord(" "), True
    at = t.first[words][opening]
    offsets = np.append(np.concatenate([[0], np.cumsum(kept)])[at], kept.sum()).astype(np.int32)
    body = out[kept].tobytes()
    sentences = pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets.tobytes()), pa.py_buffer(body))
    return sentences, np.bincount(t.of[words][opening], minlength=len(texts))


def _cutter(sent):
    """Column function: the sentences of every text; ``sent`` has the lists
    that are sent, further columns those that are joined."""
    @F.arrow_udf("array<string>")
    def cut(texts: pa.Array, keyed: pa.Array, mine: pa.Array, after: pa.Array) -> pa.Array:
        # whether a word is listed is the same for all texts that have it
        lists = [pa.concat_arrays([known, own.flatten().cast(known.type)]) for known, own in zip(sent.value, (mine, after))]
        keyed = keyed.to_numpy(zero_copy_only=False).astype(bool)
        found, n = [pa.array([], pa.string())], [np.zeros(0, np.int64)]
        for i, j in wordruns.blocks(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64), TEXT_AT_ONCE):
            got = _block_sentences(texts.slice(i, j - i), keyed[i:j], *lists)
            found.append(got[0])
            n.append(got[1])
        at = np.concatenate([[0], np.cumsum(np.concatenate(n))])
        return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.concat_arrays(found))
    return cut


def split_learned(docs: DataFrame, key: str, text_col: str, abbreviations: DataFrame, starters: DataFrame) -> DataFrame:
    """``docs`` plus ``sentences``.  ``key`` names a row; rows without one
    are cut without the lists."""
    spark = docs.sparkSession
    bounded_batches(spark)
    sent = [_short(abbreviations), _short(starters)]
    if all(x is not None for x in sent):
        none = F.lit(None).cast("array<string>")
        d = docs.withColumns({"_abbreviations": none, "_starters": none})
    else:
        sent = [pa.array([], pa.large_string())] * 2
        rows = token_rows(docs, key, text_col).where("dotted and next is not null")
        word = _core(F.col("next"))
        mine = rows.select(key, "base").distinct().join(abbreviations, "base").groupBy(key).agg(
            F.collect_list("base").alias("_abbreviations"))
        after = rows.select(key, word.alias("word")).distinct().join(starters, "word").groupBy(key).agg(
            F.collect_list("word").alias("_starters"))
        d = docs.join(mine, key, "left").join(after, key, "left")
    cut = _cutter(spark.sparkContext.broadcast(sent))
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = cut(text, F.col(key).isNotNull(), F.col("_abbreviations"), F.col("_starters"))
    return d.withColumn("sentences", found).drop("_abbreviations", "_starters")
