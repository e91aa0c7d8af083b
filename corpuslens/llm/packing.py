"""Bulk-synchronous best-fit packing of token sequences.

Documents are tokenised, cut only where they exceed the capacity, and their
pieces packed into sequences of at most ``capacity`` tokens.

Pieces are range-sorted by length once, sequences by their gap once a round,
and each gets its rank within its size, over all partitions.  A round is a
sweep from the largest size down over the two sorted runs: every piece goes
for its successor, the smallest gap that holds it.  Pieces of one size want
the same gaps, so the conflict is resolved by rank: the first pieces get the
first gap, as many as it holds (best fit would put them there one by one),
the next ones the next gap, and when a size of gaps is used up the next
larger one follows.  Then the gaps are updated, sorted again, and the next
round begins; when nothing fits, new sequences are opened.  There are at most
``capacity`` sizes, so what a round agrees on is a short list of rank ranges
(at most two per size), whatever the number of pieces; the rows themselves
stay in Spark and meet once at the end, by (round, gap, rank), which is even.

Defined results: null and empty texts are one token (the end id); very long
texts are tokenised whole, part by part at white space, and cut into full
sequences and a rest; pieces of equal length go by (doc_id, piece), null
doc_id first; repeated rows are packed each for itself; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.llm.common import at_gaps, empty_if_null, prepared, query, saved, table

CAPACITY = 2048
TOKENIZER = "word_bpe_49k.json"
#: words whose ids a worker remembers before it starts anew
CACHED_WORDS = 1_500_000
#: bytes of text whose words are looked up together
BLOCK_BYTES = 8 << 20
#: ASCII marks that may follow a letter; none of them joins it in a token
_MARKS = b".,!?;:|#*$%&()-\""

# How the tokenizer's vocabulary writes bytes that it can't print
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_LEVEL = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTED)}

_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


class _Rows(dict):
    """word -> its row in the table; an unknown word gets the next one."""

    def __init__(self):
        super().__init__()
        self.new = []

    def __missing__(self, word):
        row = self[word] = len(self)
        self.new.append(word)
        return row


class WordIds:
    """Token ids of texts by their words.

    The tokenizer drops white space, lower-cases, and none of its rules
    reaches across white space or from a letter to a mark behind it.  So a
    text's ids are those of its words in a row, a word's are those of its stem
    and its trailing marks, and each distinct word is looked at only once
    while it is remembered.  Words are rows of one table of ids, so a text
    costs a dictionary look-up a word and one gather.
    """

    #: stands for the end of a text; no word is empty
    END = b""

    def __init__(self, tokenizer: str, end_id: int = 0):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        if not os.path.isabs(tokenizer):
            import public_tokenizers
            tokenizer = public_tokenizers.path(tokenizer)
        self.tokenizer, self.end_id = Tokenizer.from_file(tokenizer), end_id
        self.forget()

    def forget(self):
        """An empty table: its first row is the end of a text."""
        self.rows = _Rows()
        self.rows[self.END] = 0
        self.pool, self.used = np.array([self.end_id], np.uint32), 1
        self.start, self.count = np.zeros(1, np.int64), np.ones(1, np.int64)

    @staticmethod
    def words(body: bytes) -> list[bytes]:
        # special tokens in a text are recognised in lower case only: leave them
        return (body if b"<|" in body else body.lower()).split()

    @staticmethod
    def stem(word: bytes) -> bytes:
        """``word`` without trailing marks, if what is left ends in a letter."""
        cut = word.rstrip(_MARKS)
        if cut == word or not cut or cut[-1] < 128 and not cut[-1:].isalpha():
            return word
        return cut if cut[-1] < 128 or cut.decode()[-1].isalpha() else word

    def encode(self, words: list[bytes]) -> tuple[list[int], list[int]]:
        """ids of ``words`` in a row, and how many each has.  Lower-case Latin
        words are one token of the pre-tokenizer and go to its model at once;
        others all the way."""
        ids, sizes, tokenize = [], [], self.tokenizer.model.tokenize
        for w in words:
            if w.isalpha() and w.islower():  # of ASCII letters
                found = [t.id for t in tokenize(w.decode())]
            else:
                text = w.decode()
                if text.isalpha() and max(text) < "\u0250" and text.lower() == text:
                    found = [t.id for t in tokenize(w.decode("latin-1").translate(_BYTE_LEVEL))]
                else:
                    found = self.tokenizer.encode(text, add_special_tokens=False).ids
            ids += found
            sizes.append(len(found))
        return ids, sizes

    def learn(self):
        """Table rows for the words met since, and for the stems and marks
        that they consist of."""
        rows, new, plain, marked = self.rows, self.rows.new, [], []
        rows.new = []
        for w in new:
            if not 97 <= w[-1] <= 122 and len(s := self.stem(w)) < len(w):
                marked.append((rows[w], rows[s], rows[w[len(s):]]))
            else:
                plain.append(w)
        plain += rows.new  # stems and marks asked for just now
        rows.new = []
        grown = len(rows) - len(self.start)
        if grown > 0:
            more = np.zeros(max(grown, len(self.start)), np.int64)
            self.start, self.count = np.concatenate([self.start, more]), np.concatenate([self.count, more])
        ids, sizes = self.encode(plain)
        self.store(np.fromiter(map(rows.__getitem__, plain), np.int64, len(plain)),
                   np.array(ids, np.uint32), np.array(sizes, np.int64))
        if marked:
            row, stem, tail = np.array(marked, np.int64).T
            self.store(row, self.gather(np.stack([stem, tail], 1).ravel()), self.count[stem] + self.count[tail])

    def store(self, rows: np.ndarray, ids: np.ndarray, sizes: np.ndarray):
        """Append the ids of the words in ``rows`` to the pool."""
        if self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(max(len(ids), len(self.pool)), np.uint32)])
        self.pool[self.used:self.used + len(ids)] = ids
        self.start[rows] = self.used + np.cumsum(sizes) - sizes
        self.count[rows] = sizes
        self.used += len(ids)

    def gather(self, rows: np.ndarray) -> np.ndarray:
        """ids of the words in ``rows``, one after the other."""
        count = self.count[rows]
        before = np.cumsum(count) - count
        return self.pool[np.arange(int(count.sum())) + np.repeat(self.start[rows] - before, count)]

    def __call__(self, bodies: list[bytes], ends: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """ids of all ``bodies`` in a row, each with its end id if ``ends``,
        and where each body's ids stop."""
        if len(self.rows) > CACHED_WORDS:
            self.forget()
        split = [self.words(b) for b in bodies]
        if ends:
            for words in split:
                words.append(self.END)
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        at = np.fromiter(map(self.rows.__getitem__, chain.from_iterable(split)), np.int64, int(sizes.sum()))
        if self.rows.new:
            self.learn()
        stops = np.concatenate([[0], np.cumsum(self.count[at])])[np.cumsum(sizes)]
        return self.gather(at), stops


_TOKENIZERS: dict = {}


def _text_blocks(bodies: list[bytes]):
    """Slices of about BLOCK_BYTES; a larger body stands alone."""
    start = held = 0
    for i, b in enumerate(bodies):
        if held and held + len(b) > BLOCK_BYTES:
            yield start, i
            start, held = i, 0
        held += len(b)
    if start < len(bodies):
        yield start, len(bodies)


def _pieces(tokenizer, capacity, with_ids, end_id):
    def run(batches):
        # a worker process serves many tasks and keeps what it has learned
        key = (tokenizer, end_id)
        ids_of = _TOKENIZERS.get(key) or _TOKENIZERS.setdefault(key, WordIds(*key))
        kinds = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(),
                 "ids_crc32": pa.int64(), "doc_tokens": pa.int64(), "ids": pa.binary()}
        if not with_ids:
            kinds.pop("ids")
        for b in batches:
            doc_ids, bodies = b.column("doc_id").to_pylist(), b.column("body").to_pylist()
            for i, j in _text_blocks(bodies):
                out = {k: [] for k in kinds}
                # a longer body is a block of its own and tokenised part by part
                if j - i == 1:
                    parts = [ids_of([part], ends=False)[0] for part in at_gaps(bodies[i], BLOCK_BYTES)]
                    ids = np.concatenate([*parts, np.array([end_id], np.uint32)])
                    stops = [len(ids)]
                else:
                    ids, stops = ids_of(bodies[i:j])
                    stops = stops.tolist()
                body = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
                for doc_id, first, stop in zip(doc_ids[i:j], [0, *stops], stops):
                    for piece, at in enumerate(range(first, stop, capacity)):
                        part = body[4 * at:4 * min(at + capacity, stop)]
                        row = (doc_id, piece, at - first, len(part) // 4, zlib.crc32(part), stop - first)
                        for k, v in zip(out, (*row, bytes(part)) if with_ids else row, strict=True):
                            out[k].append(v)
                yield pa.RecordBatch.from_pydict({k: pa.array(v, kinds[k]) for k, v in out.items()})
    return run


def token_pieces(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY,
                 with_ids: bool = False, end_id: int = 0) -> DataFrame:
    """Pieces of every document, in its order: doc_id, piece, start, length,
    ids_crc32, doc_tokens (all ids of its document); ``with_ids`` adds their
    ids (unsigned 32-bit)."""
    prepared(docs.sparkSession)
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), empty_if_null().cast("binary").alias("body"))
            .mapInArrow(_pieces(tokenizer, capacity, with_ids, end_id),
                        _PIECE + ", doc_tokens long" + (", ids binary" if with_ids else "")))


def ranked(df: DataFrame, size: str, order: list[str], parts: int) -> tuple[DataFrame, dict[int, int]]:
    """``df`` plus _rank, gapless from 0 within each value of ``size``, and
    the number of rows per size.  A range sort; no size is gathered."""
    d = saved(df.repartitionByRange(parts, size, *order).sortWithinPartitions(size, *order)
              .withColumns({"_pid": F.spark_partition_id(),
                            "_pos": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}))
    # sorted: at most one row per partition and per size
    counts = sorted(d.groupBy(size, "_pid").agg(F.count("*"), F.min("_pos")).collect())
    before, rows = {}, []
    for value, pid, n, first in counts:
        rows.append((value, pid, before.get(value, 0) - first))
        before[value] = before.get(value, 0) + n
    if not rows:
        return d.withColumn("_rank", F.lit(0).cast("long")).drop("_pid", "_pos"), {}
    shift = df.sparkSession.createDataFrame(rows, "_s long, _p int, _shift long")
    return (d.join(F.broadcast(shift), (F.col(size) == F.col("_s")) & (F.col("_pid") == F.col("_p")))
            .withColumn("_rank", F.col("_pos") + F.col("_shift")).drop("_pid", "_pos", "_s", "_p", "_shift"), before)


def sweep(pieces: np.ndarray, used: np.ndarray, gaps: np.ndarray) -> list[tuple]:
    """One round: (length, first rank, last rank + 1, gap, first gap rank,
    pieces per gap) for every range that is placed.

    ``pieces`` counts unplaced pieces by length, ``used`` those placed before
    (both are updated), ``gaps`` open sequences by gap."""
    placed, stack = [], []
    taken = np.zeros_like(gaps)
    for size in range(len(pieces) - 1, 0, -1):
        if gaps[size]:
            stack.append(size)
        while pieces[size] and stack:
            gap = stack[-1]
            each = gap // size
            n = min(int(gaps[gap] - taken[gap]), int(pieces[size]) // each)
            if n == 0:  # fewer left than one gap holds
                n, each = 1, int(pieces[size])
            placed.append((size, int(used[size]), int(used[size]) + n * each, gap, int(taken[gap]), each))
            used[size] += n * each
            pieces[size] -= n * each
            taken[gap] += n
            if taken[gap] == gaps[gap]:
                stack.pop()
    return placed


def place_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces(doc_id, piece, start, length, ...)`` plus sequence_id, offset."""
    spark = pieces.sparkSession
    parts = prepared(spark)
    docs, by_length = ranked(saved(pieces), "length", ["doc_id", "piece"], parts)
    docs = saved(docs)
    left, used = np.zeros(capacity + 1, np.int64), np.zeros(capacity + 1, np.int64)
    for length, n in by_length.items():
        left[length] = n
    whole, left[capacity] = int(left[capacity]), 0
    opened, turn = 0, 0
    gaps, ranges, met = None, [], []
    while left.any():
        counts = np.zeros(capacity + 1, np.int64)
        table_of_gaps = None
        if gaps is not None:
            smallest = int(np.flatnonzero(left)[0])
            # a gap below the smallest unplaced piece is closed
            table_of_gaps, sizes = ranked(gaps.filter(F.col("gap") >= smallest), "gap", ["sequence_id"], parts)
            for size, n in sizes.items():
                counts[size] = n
        placed = sweep(left, used, counts)
        if not placed:
            # every open gap is too small: new sequences, as many as the rest needs at least
            n = -(-int((left * np.arange(capacity + 1)).sum()) // capacity)
            gaps = spark.range(opened, opened + n).select(F.col("id").alias("sequence_id"),
                                                          F.lit(capacity).cast("long").alias("gap"))
            opened += n
            continue
        turn += 1
        ranges += [(turn, *p) for p in placed]
        took = spark.createDataFrame([(p[3], p[4], p[4] + (p[2] - p[1]) // p[5], p[0] * p[5]) for p in placed],
                                     "g long, g0 long, g1 long, tokens long")
        state = saved(table_of_gaps.join(F.broadcast(took), (F.col("gap") == F.col("g")) & (F.col("_rank") >= F.col("g0"))
                                         & (F.col("_rank") < F.col("g1")), "left")
                      .select("sequence_id", "gap", "_rank", F.coalesce("tokens", F.lit(0)).alias("tokens")))
        met.append(state.filter("tokens > 0").select(F.lit(turn).alias("s_turn"), F.col("gap").alias("s_gap"),
                                                     F.col("_rank").alias("s_rank"), "sequence_id"))
        gaps = state.select("sequence_id", (F.col("gap") - F.col("tokens")).alias("gap"))
    full = docs.filter(F.col("length") == capacity).withColumns(
        {"sequence_id": F.col("_rank") + opened, "offset": F.lit(0).cast("long")}).drop("_rank")
    if not ranges:
        return full
    plan = spark.createDataFrame(ranges, "turn int, p_length long, p0 long, p1 long, p_gap long, g0 long, per long")
    seen = met[0]
    for m in met[1:]:
        seen = seen.unionByName(m)
    wanted = docs.join(F.broadcast(plan), (F.col("length") == F.col("p_length")) & (F.col("_rank") >= F.col("p0"))
                       & (F.col("_rank") < F.col("p1")))
    wanted = wanted.withColumns({
        "g_rank": F.col("g0") + F.expr("(_rank - p0) div per"),
        "offset": F.lit(capacity) - F.col("p_gap") + F.expr("(_rank - p0) % per") * F.col("length")})
    part = (wanted.join(seen, (F.col("turn") == F.col("s_turn")) & (F.col("p_gap") == F.col("s_gap"))
                        & (F.col("g_rank") == F.col("s_rank")))
            .select(*pieces.columns, "sequence_id", "offset"))
    return part.unionByName(full)


def pack(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return place_pieces(token_pieces(docs, tokenizer, capacity).drop("doc_tokens"), capacity)


def sequences(docs: DataFrame, packed: DataFrame, tokenizer: str = TOKENIZER,
              capacity: int = CAPACITY) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids (little-endian
    unsigned 32-bit).  A group is one sequence."""
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    ids = token_pieces(docs, tokenizer, capacity, with_ids=True).dropDuplicates(key)
    joined = packed.alias("p").join(ids.alias("i"), [F.col(f"p.{c}").eqNullSafe(F.col(f"i.{c}")) for c in key])
    return (joined.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
            .select("sequence_id", F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids")))


@query("op2_best_fit_packing")
def op2_best_fit_packing(spark, sf_dir):
    """All documents packed into sequences of at most 2048 tokens."""
    return pack(table(spark, sf_dir, "documents"))
