"""Exact dedup with Patricia-trie owners.

Texts are compared after deleting white space.  Each scan task first puts
its texts into a compressed radix trie (a combiner: a text that fills a third
of the table leaves every task once).  What it holds is shuffled to
partitions by byte length and content hash; there the full byte strings of
one length and hash go into a trie of their own, whose terminal nodes keep
the owner: most code points in the original text, then smallest doc_id.

Memory: a trie counts the bytes it holds; above its budget the heaviest
subtree is spilled, that is, its terminals are handed downstream as partial
rows, which the next trie merges.  So nothing is written beside Spark's own
shuffle, and lost executors only cost a recomputation.

Defined results: null text counts as empty; null doc_id is the last owner to
be chosen; of rows equal in doc_id and text one is kept; an empty table gives
an empty result; extra columns are carried by ``keep_owners`` and ignored by
``exact_groups``.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.common import SPACE, boxed, empty_if_null, prepared, query, saved, sized, table, unboxed

#: bytes that a task's trie may hold before it spills a subtree
TRIE_BYTES = 48 << 20
_NODE_BYTES = 200  # what a node costs beside its label

_PART = ("n_bytes int, hash long, body binary, chars long, doc_id long, count long, ties long")
_CLASS = "sha string, keep_id long, keep_chars long, group_size long, ties long"


class _Node:
    __slots__ = ("label", "kids", "owner", "count", "ties")

    def __init__(self, label, owner=None, count=0, ties=0):
        self.label, self.kids, self.owner, self.count, self.ties = label, {}, owner, count, ties

    def merge(self, owner, count, ties):
        if self.owner is None or owner < self.owner:
            self.owner, self.ties = owner, ties
        elif owner == self.owner:
            self.ties += ties
        self.count += count


def _common(a: bytes, b: bytes, at: int) -> int:
    """Length of the common prefix of ``a`` and ``b[at:]``."""
    lo, hi = 0, min(len(a), len(b) - at)
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[lo:mid] == b[at + lo:at + mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


class PatriciaTrie:
    """Compressed radix trie over byte strings with owners at terminals.

    An owner is a tuple that sorts smallest first.  ``held`` is an upper
    bound of the memory in use.
    """

    def __init__(self):
        self.root, self.held = _Node(b""), 0

    def add(self, body: bytes, owner: tuple, count: int = 1, ties: int = 1) -> None:
        node, at = self.root, 0
        while at < len(body):
            kid = node.kids.get(body[at])
            if kid is None:
                node.kids[body[at]] = _Node(body[at:], owner, count, ties)
                self.held += len(body) - at + _NODE_BYTES
                return
            if body.startswith(kid.label, at):
                node, at = kid, at + len(kid.label)
                continue
            same = _common(kid.label, body, at)
            fork = _Node(kid.label[:same])
            kid.label = kid.label[same:]
            fork.kids[kid.label[0]] = kid
            node.kids[body[at]] = fork
            self.held += _NODE_BYTES
            node, at = fork, at + same
        node.merge(owner, count, ties)

    @staticmethod
    def terminals(node, prefix: bytes = b""):
        """(body, owner, count, ties) of every terminal below ``node``."""
        stack = [(node, prefix)]
        while stack:
            node, prefix = stack.pop()
            body = prefix + node.label
            if node.owner is not None:
                yield body, node.owner, node.count, node.ties
            stack += [(kid, body) for kid in node.kids.values()]

    def spill(self):
        """Take out the heaviest subtree below the root and yield its terminals."""
        def weight(node):
            total, stack = 0, [node]
            while stack:
                x = stack.pop()
                total += len(x.label) + _NODE_BYTES
                stack += x.kids.values()
            return total
        first, heavy = max(((b, weight(n)) for b, n in self.root.kids.items()), key=lambda x: x[1])
        self.held -= heavy
        yield from self.terminals(self.root.kids.pop(first))


def _owner(chars, doc_id):
    return (-chars, doc_id is None, doc_id or 0)


def _owner_row(owner):
    return -owner[0], None if owner[1] else owner[2]


def _batches(rows, schema, limit=4 << 20):
    """Arrow batches of bounded size from (bytes, row) pairs."""
    held, cols = 0, []
    for weight, row in rows:
        cols.append(row)
        held += weight
        if held > limit:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t.type) for c, t in zip(zip(*cols), schema, strict=True)], schema=schema)
            held, cols = 0, []
    if cols:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t.type) for c, t in zip(zip(*cols), schema, strict=True)], schema=schema)


_PART_ARROW = pa.schema([("n_bytes", pa.int32()), ("hash", pa.int64()), ("body", pa.binary()),
                         ("chars", pa.int64()), ("doc_id", pa.int64()), ("count", pa.int64()), ("ties", pa.int64())])
_CLASS_ARROW = pa.schema([("sha", pa.string()), ("keep_id", pa.int64()), ("keep_chars", pa.int64()),
                          ("group_size", pa.int64()), ("ties", pa.int64())])


def _combine(budget):
    def run(batches):
        trie = PatriciaTrie()

        def rows():
            for batch in batches:
                d = batch.to_pydict()
                for doc_id, chars, h, body in zip(d["doc_id"], d["chars"], d["hash"], d["body"], strict=True):
                    # the hash rides behind the owner; equal texts have equal ones
                    trie.add(body, _owner(chars, doc_id) + (h,))
                    while trie.held > budget and trie.root.kids:
                        yield from out(trie.spill())
            yield from out(trie.terminals(trie.root))

        def out(found):
            for body, owner, count, ties in found:
                chars, doc_id = _owner_row(owner)
                yield len(body) + 64, (len(body), owner[3], body, chars, doc_id, count, ties)

        yield from _batches(rows(), _PART_ARROW)
    return run


def _own(batches):
    """Rows sorted by (n_bytes, hash): one trie for each of these buckets."""
    def rows():
        trie, at = PatriciaTrie(), None
        for batch in batches:
            d = batch.to_pydict()
            for n, h, body, chars, doc_id, count, ties in zip(*d.values(), strict=True):
                if (n, h) != at:
                    yield from out(trie)
                    trie, at = PatriciaTrie(), (n, h)
                trie.add(body, _owner(chars, doc_id), count, ties)
        yield from out(trie)

    def out(trie):
        for body, owner, count, ties in trie.terminals(trie.root):
            if count > 1:
                chars, doc_id = _owner_row(owner)
                yield 128, (hashlib.sha256(body).hexdigest(), doc_id, chars, count, ties)

    yield from _batches(rows(), _CLASS_ARROW)


def _keyed(docs: DataFrame) -> DataFrame:
    text = empty_if_null("_row.text")
    return boxed(docs).withColumns({
        "doc_id": F.col("_row.doc_id").cast("long"), "chars": F.length(text).cast("long"),
        "norm": F.translate(text, SPACE, "")})


def owner_classes(docs: DataFrame, trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """One row per text that occurs more than once: its SHA-256, the owner's
    doc_id and code points, rows, and rows that equal the owner."""
    n = prepared(docs.sparkSession)
    parts = (_keyed(docs)
             .select("doc_id", "chars", F.xxhash64("norm").alias("hash"), F.col("norm").cast("binary").alias("body"))
             .mapInArrow(_combine(trie_bytes), _PART))
    return (parts.repartition(n, "n_bytes", "hash").sortWithinPartitions("n_bytes", "hash")
            .mapInArrow(_own, _CLASS))


def _with_class(docs: DataFrame, classes: DataFrame) -> DataFrame:
    keyed = _keyed(docs).withColumn("text_sha256", F.sha2("norm", 256)).drop("norm")
    owner = F.col("keep_id").eqNullSafe(F.col("doc_id")) & (F.col("keep_chars") == F.col("chars"))
    return (keyed.join(sized(classes, 160), F.col("text_sha256") == F.col("sha"), "left")
            .withColumn("kept", F.col("sha").isNull() | owner))


def exact_groups(docs: DataFrame, trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row."""
    classes = saved(owner_classes(docs, trie_bytes))
    rows = saved(_with_class(docs.select("doc_id", "text"), classes).select(
        "doc_id", F.when(F.col("sha").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), "kept", "text_sha256",
        (F.coalesce("ties", F.lit(1)) > 1).alias("tied")))
    twice = F.col("kept") & F.col("tied")
    plain = rows.filter(~twice).drop("tied")
    # rows that repeat the owner: count them, then one of them stays
    again = (rows.filter(twice).groupBy("doc_id", "keep_id", "group_size", "text_sha256").count()
             .withColumn("i", F.explode(F.sequence(F.lit(1), F.col("count").cast("int"))))
             .select("doc_id", "keep_id", "group_size", (F.col("i") == 1).alias("kept"), "text_sha256"))
    return plain.unionByName(again)


def keep_owners(docs: DataFrame, trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    classes = saved(owner_classes(docs, trie_bytes))
    rows = _with_class(docs, classes).filter("kept")
    if classes.filter("ties > 1").isEmpty():
        return unboxed(rows)
    tied = F.coalesce("ties", F.lit(1)) > 1
    # rows that repeat the owner: one of them stays
    return unboxed(rows.filter(~tied).unionByName(rows.filter(tied).dropDuplicates(["doc_id", "text_sha256"])))


DEDUP_SQL = r"""
with d as (
  select doc_id, length(coalesce(text, '')) as chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as sha
  from documents),
w as (select *, first_value(doc_id) over g as keep_id, count(*) over (partition by sha) as group_size,
             row_number() over g as i
      from d window g as (partition by sha order by chars desc, doc_id nulls last))
select doc_id, keep_id, group_size::bigint as group_size, i = 1 as kept, sha as text_sha256 from w"""


@query("op6_exact_dedup", DEDUP_SQL)
def op6_exact_dedup(spark, sf_dir):
    """Every document with the owner of its text."""
    return exact_groups(table(spark, sf_dir, "documents"))
