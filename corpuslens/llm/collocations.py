r"""Phrase collocations by stripes.

Every prefix of one or two words keys an associative counter of the words
that follow it, its stripe.  A task counts a block of text and hands on one
stripe per prefix it has met; stripes of equal prefixes meet and are added
element by element.  The merged stripes hold everything that scores need: an
element is f(prefix + next word), a word's total is f(word) (some of it ends
a piece, so that nothing follows), and the largest element of a pair's
stripe, with the elements that end in the pair, tells how much of the pair a
longer phrase accounts for.

Most prefixes are rare, so stripes travel packed: prefixes are dealt into
buckets by hash, one for half a million words of the corpus, and a task hands on
one row per bucket.  A bucket's stripes are merged together.

A prefix that is frequent (at least ``1 / (8 * shuffle partitions)`` of its
language's words) has its stripe divided by a hash of the next word, in
proportion to its share, so no task merges more than its part of it.  These
words are found in a first pass over all texts; there are at most
``16 * shuffle partitions`` a language, so they are sent to every task.

Scores compare products beyond 64 bits, so they are decimals with 35 digits
and divide exactly.

Defined results: null text counts as empty, null lang as ``und``; texts
without words add nothing; repeated rows count each; very long texts are
read part by part, without losing the phrases across two parts; phrases that
tie go by their UTF-8 bytes; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.llm.common import empty_if_null, prepared, query, saved, sized, table

MIN_COUNT = 10
#: a longer phrase with this share of a phrase' occurrences replaces it
SUBSUMED = 0.5
TOP = 2000
SCALE = 1_000_000
#: words that a task counts before it hands on their stripes
BLOCK_WORDS = 1 << 20
#: bytes of a text that are split into words at a time
PART_BYTES = 4 << 20
#: words of the corpus for each bucket of stripes
BUCKET_WORDS = 1 << 19
#: buckets are merged together until they have as many elements
MERGE_ELEMENTS = 1 << 18
#: prefixes of an Arrow batch of stripes
OUT_ROWS = 1 << 16

# Fixed values of the contract: A-Z in lower case, the marks that end a piece
# (as 0xFF, which no UTF-8 text has), tab as space
_MARKS = b".,;:!?\n\x0b\x0c\r"
_FOLD = bytes.maketrans(bytes(range(65, 91)) + _MARKS + b"\t", bytes(range(97, 123)) + b"\xff" * len(_MARKS) + b" ")
_END = b"\xff"

# stripes of one language and bucket: prefixes and next words joined, as many
# elements of each prefix as "size" says
_PACKED = ("lang string, bucket int, prefixes string, total array<long>, size array<int>, next string, count array<int>")
_PACKED_ARROW = pa.schema([
    ("lang", pa.string()), ("bucket", pa.int32()), ("prefixes", pa.string()), ("total", pa.list_(pa.int64())),
    ("size", pa.list_(pa.int32())), ("next", pa.string()), ("count", pa.list_(pa.int32()))])
_STRIPES = "lang string, prefix string, total long, next array<string>, count array<long>"
_ARROW = pa.schema([("lang", pa.string()), ("prefix", pa.string()), ("total", pa.int64()),
                    ("next", pa.list_(pa.string())), ("count", pa.list_(pa.int64()))])


class _Ids(dict):
    """word -> its number in the block; 0 ends a piece."""

    def __init__(self):
        super().__init__({_END: 0})

    def __missing__(self, word):
        n = self[word] = len(self)
        return n


def _parts(body: bytes):
    """Folded text in parts of bounded size, cut at spaces."""
    body = body.translate(_FOLD)
    at = 0
    while len(body) - at > PART_BYTES:
        cut = body.find(b" ", at + PART_BYTES)
        if cut < 0:
            break
        yield body[at:cut]
        at = cut
    yield body[at:]


class _Block:
    """Words of a block of texts as numbers, by language.

    ``spans`` are (words, how many of them were counted before): a text that
    goes on in the next block starts there with its last two words again."""

    def __init__(self):
        self.ids, self.spans, self.size = _Ids(), {}, 0

    def add(self, lang: str, words: list[bytes], counted: int):
        found = np.fromiter(map(self.ids.__getitem__, words), np.int64, len(words))
        self.spans.setdefault(lang, []).append((found, counted))
        self.size += len(words)

    def joined(self, lang: str) -> tuple[np.ndarray, np.ndarray]:
        """All words of a language, ends between texts, and which are counted here."""
        end = np.zeros(1, np.int64)
        words, fresh = [], []
        for found, counted in self.spans[lang]:
            words += [found, end]
            fresh += [np.zeros(counted, bool), np.ones(len(found) + 1 - counted, bool)]
        return np.concatenate(words), np.concatenate(fresh)


def _blocks(batches):
    """Blocks of about BLOCK_WORDS words of (lang, body) batches."""
    block = _Block()
    for b in batches:
        for lang, body in zip(b.column("lang").to_pylist(), b.column("body").to_pylist(), strict=True):
            tail = []
            for part in _parts(body):
                words = part.replace(_END, b" \xff ").split()
                block.add(lang, tail + words, len(tail))
                tail = (tail + words)[-2:]
                if block.size >= BLOCK_WORDS:
                    yield block
                    block = _Block()
    if block.size:
        yield block


def _count_frequent(share: float):
    """Words of each block and, for its frequent words, their occurrences."""
    def run(batches):
        for block in _blocks(batches):
            vocabulary = list(block.ids)
            rows = []
            for lang in block.spans:
                words, fresh = block.joined(lang)
                counts = np.bincount(words[fresh], minlength=len(vocabulary))
                counts[0] = 0
                n = int(counts.sum())
                rows.append((lang, None, n))
                rows += [(lang, vocabulary[i].decode(), int(counts[i])) for i in np.flatnonzero(counts >= max(share * n, 1))]
            cols = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()),
                                              pa.array(cols[2], pa.int64())], ["lang", "word", "n"])
    return run


def frequent_words(texts: DataFrame, parts: int) -> tuple[DataFrame, dict[tuple[str, str], int]]:
    """(lang, n) of all words, and the parts of each frequent word's stripe.

    A word with a share of 1/parts has at least half of that outside the
    blocks where it has less than half, so those blocks needn't tell it."""
    found = saved(texts.mapInArrow(_count_frequent(0.5 / parts), "lang string, word string, n long")
                  .groupBy("lang", "word").agg(F.sum("n").alias("n")))
    total = found.filter("word is null").select("lang", "n")
    often = (found.filter("word is not null").join(total.withColumnRenamed("n", "all"), "lang")
             .filter(F.col("n") * (2 * parts) >= F.col("all"))
             .select("lang", "word", F.ceil(F.col("n") * parts / F.col("all")).cast("int").alias("parts")))
    # at most 2 * parts words a language
    return total, {(r[0], r[1]): r[2] for r in often.filter("parts > 1").collect()}


def _packed(lang: str, names: pa.Array, first: np.ndarray, second: np.ndarray | None, total: np.ndarray | None,
            element: np.ndarray, count: np.ndarray, parts: np.ndarray, hashes: np.ndarray, buckets: int):
    """Rows of stripes of one block and language, one per bucket.

    Prefixes are the words ``first`` (and ``second``), sorted; ``element`` is
    the prefix' index * number of words + next word, sorted.  A stripe lies in
    its prefix' bucket, the parts of a divided one in several; ``total`` goes
    to the first part."""
    n = len(first)
    home = _mix(hashes[first] + np.uint64(zlib.crc32(lang.encode())))
    if second is not None:
        home = _mix(home + hashes[second])
    owner, word = element // len(names), element % len(names)
    part = hashes[word] % parts[owner].astype(np.uint64)
    at = _mix(home[owner] + part) % np.uint64(buckets)
    key = at.astype(np.int64) * n + owner
    order = np.argsort(key, kind="stable")
    key, word, count = key[order], word[order], count[order]
    rows = np.unique(key)
    if total is not None:
        rows = np.union1d(rows, (_mix(home) % np.uint64(buckets)).astype(np.int64) * n + np.arange(n))
    bucket, owner = rows // n, rows % n
    prefix = names.take(pa.array(first[owner]))
    if second is not None:
        prefix = pc.binary_join_element_wise(prefix, names.take(pa.array(second[owner])), " ")
    told = np.zeros(len(rows), np.int64)
    if total is not None:
        own = bucket == (_mix(home[owner]) % np.uint64(buckets)).astype(np.int64)
        told[own] = total[owner[own]]
    start = np.searchsorted(key, rows)
    size = np.diff(np.append(start, len(key)))
    for i in range(0, len(rows), OUT_ROWS):
        j = min(i + OUT_ROWS, len(rows))
        x, y = int(start[i]), int(start[j]) if j < len(rows) else len(key)
        edge = np.flatnonzero(np.append(True, bucket[i + 1:j] != bucket[i:j - 1]))
        by_row = pa.array(np.append(edge, j - i), pa.int32())
        by_element = pa.array(np.append(start[i:j][edge], y) - x, pa.int32())
        yield pa.RecordBatch.from_arrays([
            pa.array([lang] * len(edge), pa.string()), pa.array(bucket[i:j][edge], pa.int32()),
            pc.binary_join(pa.ListArray.from_arrays(by_row, prefix.slice(i, j - i)), "\n"),
            pa.ListArray.from_arrays(by_row, pa.array(told[i:j], pa.int64())),
            pa.ListArray.from_arrays(by_row, pa.array(size[i:j], pa.int32())),
            pc.binary_join(pa.ListArray.from_arrays(by_element, names.take(pa.array(word[x:y]))), " "),
            pa.ListArray.from_arrays(by_element, pa.array(count[x:y], pa.int32()))], schema=_PACKED_ARROW)


def _mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (products wrap around)."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def _count_stripes(frequent: dict[tuple[str, str], int], buckets: int):
    def run(batches):
        for block in _blocks(batches):
            vocabulary = list(block.ids)
            base = len(vocabulary)
            hashes = np.fromiter(map(zlib.crc32, vocabulary), np.uint64, base)
            names = pa.array(vocabulary[1:], pa.binary()).cast(pa.string())
            names = pa.concat_arrays([pa.array([""], pa.string()), names])
            for lang in block.spans:
                words, fresh = block.joined(lang)
                parts = np.ones(base, np.int64)
                for (of, w), n in frequent.items():
                    if of == lang and (i := block.ids.get(w.encode())):
                        parts[i] = n
                pair = words[:-1] * base + words[1:]
                pair_at = (words[:-1] > 0) & (words[1:] > 0)
                three_at = pair_at[:-1] & pair_at[1:] & fresh[2:]
                pairs, pair_n = np.unique(pair[pair_at & fresh[1:]], return_counts=True)
                threes, three_n = np.unique(pair[:-1][three_at] * base + words[2:][three_at], return_counts=True)
                counts = np.bincount(words[fresh], minlength=base)
                counts[0] = 0
                # a prefix that was counted in the block before has total 0 here
                ones = np.union1d(np.flatnonzero(counts), pairs // base)
                at = np.searchsorted(ones, pairs // base)
                yield from _packed(lang, names, ones, None, counts[ones], at * base + pairs % base, pair_n,
                                   parts[ones], hashes, buckets)
                twos, at = np.unique(threes // base, return_inverse=True)
                first, second = twos // base, twos % base
                yield from _packed(lang, names, first, second, None, at * base + threes % base, three_n,
                                   np.minimum(parts[first], parts[second]), hashes, buckets)
    return run


def _unpacked(column: pa.ChunkedArray, mark: str) -> pa.Array:
    return pc.split_pattern(column, mark).combine_chunks().flatten()


def _merge(batches: list[pa.RecordBatch], least: int) -> pa.RecordBatch:
    """Stripes of equal (language, prefix) added element by element; what
    occurs at least ``least`` times."""
    t = pa.Table.from_batches(batches)
    sizes = t.column("size").combine_chunks()
    rows = pc.list_value_length(sizes).to_numpy(zero_copy_only=False)
    lang = t.column("lang").combine_chunks().take(pa.array(np.repeat(np.arange(t.num_rows), rows)))
    prefix = _unpacked(t.column("prefixes"), "\n")
    total = t.column("total").combine_chunks().flatten().to_numpy()
    sizes = sizes.flatten().to_numpy()
    # an empty stripe has no word, but splitting gives it an empty one
    word = _unpacked(t.column("next"), " ")
    word = word.filter(pc.not_equal(word, ""))
    count = t.column("count").combine_chunks().flatten().to_numpy()
    group = pc.binary_join_element_wise(lang, prefix, "\n").dictionary_encode().indices.to_numpy()
    groups, where, owner = np.unique(group, return_index=True, return_inverse=True)
    totals = np.zeros(len(groups), np.int64)
    np.add.at(totals, owner, total)
    coded = word.dictionary_encode()
    width = max(len(coded.dictionary), 1)
    key, at = np.unique(np.repeat(owner, sizes) * width + coded.indices.to_numpy(), return_inverse=True)
    added = np.bincount(at, count, len(key)).astype(np.int64) if len(key) else np.zeros(0, np.int64)
    often = added >= least
    key, added = key[often], added[often]
    held = np.bincount(key // width, minlength=len(groups))
    keep = np.flatnonzero((held > 0) | (totals >= least))
    start = pa.array(np.append(0, np.cumsum(held[keep])), pa.int32())
    pick = pa.array(where[keep])
    return pa.RecordBatch.from_arrays([
        lang.take(pick), prefix.take(pick), pa.array(totals[keep], pa.int64()),
        pa.ListArray.from_arrays(start, coded.dictionary.take(pa.array(key % width))),
        pa.ListArray.from_arrays(start, pa.array(added, pa.int64()))], schema=_ARROW)


def _merge_partition(least: int):
    def run(batches):
        held, size, last = [], 0, None
        for b in batches:
            b = b.select(_PACKED_ARROW.names).cast(_PACKED_ARROW)
            bucket = b.column("bucket").to_numpy()
            for i in np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])).tolist():
                j = int(np.searchsorted(bucket, bucket[i], "right"))
                if bucket[i] != last and size >= MERGE_ELEMENTS:
                    yield _merge(held, least)
                    held, size = [], 0
                last = bucket[i]
                held.append(b.slice(i, j - i))
                size += len(held[-1].column("count").flatten())
        if held:
            yield _merge(held, least)
    return run


def merged_stripes(docs: DataFrame, least: int = MIN_COUNT) -> tuple[DataFrame, DataFrame]:
    """(lang, n) of all words, and the merged stripes with what occurs at
    least ``least`` times: lang, prefix, part, total (in part 0), next, count."""
    width = prepared(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                        empty_if_null().cast("binary").alias("body"))
    total, frequent = frequent_words(texts, 8 * width)
    total = saved(total)
    words = total.agg(F.sum("n")).first()[0] or 0
    buckets = max(width, -(-words // BUCKET_WORDS))
    rows = texts.mapInArrow(_count_stripes(frequent, buckets), _PACKED)
    dealt = rows.repartition(max(width, buckets // 8), "bucket").sortWithinPartitions("bucket")
    return total, saved(dealt.mapInArrow(_merge_partition(least), _STRIPES))


def phrase_scores(stripes: DataFrame, subsumed: float = SUBSUMED) -> DataFrame:
    """lang, phrase, a, l, r, score of all candidates that no longer
    candidate accounts for."""
    pair_prefix = F.contains("prefix", F.lit(" "))
    elements = stripes.select("lang", "prefix", F.explode(F.arrays_zip("next", "count")).alias("e")).select(
        "lang", "prefix", F.col("e.next").alias("next"), F.col("e.count").alias("a"))
    words = saved(stripes.filter(~pair_prefix & (F.col("total") > 0)).select("lang", F.col("prefix").alias("w"),
                                                                            F.col("total").alias("f")))
    pairs = saved(elements.filter(~pair_prefix).select(
        "lang", F.concat_ws(" ", "prefix", "next").alias("phrase"), F.col("prefix").alias("w1"), F.col("next").alias("w2"), "a"))
    threes = saved(elements.filter(pair_prefix).select(
        "lang", F.concat_ws(" ", "prefix", "next").alias("phrase"), F.col("prefix").alias("head"),
        F.concat_ws(" ", F.substring_index("prefix", " ", -1), "next").alias("tail"),
        F.substring_index("prefix", " ", 1).alias("w1"), F.col("next").alias("w3"), "a"))
    count_of, pair_of = sized(words, 64), sized(pairs.select("lang", "phrase", "a"), 96)

    def of(df, key, name, known, what, value):
        got = known.select(F.col("lang").alias("_l"), F.col(what).alias("_k"), F.col(value).alias(name))
        return df.join(got, (F.col("lang") == F.col("_l")) & (F.col(key) == F.col("_k"))).drop("_l", "_k")

    inside = (threes.select("lang", F.col("head").alias("phrase"), "a")
              .unionByName(threes.select("lang", F.col("tail").alias("phrase"), "a"))
              .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    twos = of(of(pairs, "w1", "l", count_of, "w", "f"), "w2", "r", count_of, "w", "f")
    twos = (twos.join(inside, ["lang", "phrase"], "left")
            .filter(F.col("longer").isNull() | (100 * F.col("longer") < int(100 * subsumed) * F.col("a")))
            .select("lang", "phrase", "a", "l", "r", score("l", "r").alias("score")))
    full = of(of(threes, "w1", "l1", count_of, "w", "f"), "w3", "r2", count_of, "w", "f")
    full = of(of(full, "head", "l2", pair_of, "phrase", "a"), "tail", "r1", pair_of, "phrase", "a")
    full = full.withColumns({"s1": score("l1", "r1"), "s2": score("l2", "r2")})
    late = F.col("s2") < F.col("s1")
    return twos.unionByName(full.select(
        "lang", "phrase", "a", F.when(late, F.col("l2")).otherwise(F.col("l1")).alias("l"),
        F.when(late, F.col("r2")).otherwise(F.col("r1")).alias("r"), F.least("s1", "s2").alias("score")))


def score(left: str, right: str):
    """floor(SCALE * a * a / (left * right)), exact: 13 digits a count."""
    return F.expr(f"(cast(a as decimal(13, 0)) * cast(a as decimal(13, 0)) * cast({SCALE} as decimal(7, 0))) "
                  f"div (cast({left} as decimal(13, 0)) * cast({right} as decimal(13, 0)))")


def collocations(docs: DataFrame, least: int = MIN_COUNT, top: int = TOP) -> DataFrame:
    """The best phrases of every language: lang, rank, phrase, a, l, r, n, score."""
    total, stripes = merged_stripes(docs, least)
    found = phrase_scores(stripes)
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # the best of every share of a language first, so that its candidates don't meet in one task
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = Window.partitionBy("lang", "_share").orderBy(*order)
    best = (found.withColumn("_share", F.pmod(F.xxhash64("phrase"), F.lit(width)))
            .withColumn("_place", F.row_number().over(share)).filter(F.col("_place") <= top).drop("_share", "_place"))
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return (ranked.filter(F.col("rank") <= top).join(sized(total, 64), "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))


OP11_SQL = r"""
with d as (
  select row_number() over () as d, coalesce(lang, 'und') as lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents),
p as (select lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) as piece from d),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from p),
g as (select lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) as phrase
      from w, (select unnest([1, 2, 3]) as k)),
f as materialized (select lang, k, phrase, count(*)::hugeint as a from g group by all),
n as (select lang, sum(a) as n from f where k = 1 group by lang),
c as materialized (select lang, k, phrase, a, string_split(phrase, ' ') as w from f where k > 1 and a >= 10),
cuts as (select c.*, h as cut, array_to_string(w[:h], ' ') as lp, array_to_string(w[h + 1:], ' ') as rp
         from c, (select unnest([1, 2]) as h) where h < k),
scored as (select cuts.*, fl.a as l, fr.a as r, (1000000::hugeint * cuts.a * cuts.a) // (fl.a * fr.a) as score
           from cuts join f fl on fl.lang = cuts.lang and fl.phrase = lp join f fr on fr.lang = cuts.lang and fr.phrase = rp),
one as (select * from scored qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
inner_of as (select lang, array_to_string(w[:2], ' ') as phrase, a from c where k = 3
             union all select lang, array_to_string(w[2:], ' '), a from c where k = 3),
longest as (select lang, phrase, max(a) as longer from inner_of group by all),
kept as (select one.* from one left join longest using (lang, phrase) where longer is null or 100 * longer < 50 * one.a),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score::bigint as score
from ranked join n using (lang) where rank <= 2000"""


@query("op11_phrase_collocations", OP11_SQL)
def op11_phrase_collocations(spark, sf_dir):
    """The 2000 best phrases of each language over all documents."""
    return collocations(table(spark, sf_dir, "documents"))
