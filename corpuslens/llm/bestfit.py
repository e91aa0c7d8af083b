"""Best-fit-decreasing packing of token sequences.

Overlong documents are first cut into full windows.  What is left, one piece a
document, is dealt out evenly in groups of at most ``GROUP`` pieces.  Each
group is packed by best-fit decreasing: pieces go from long to short, each
into the open window with the least room that still holds it, found by a
segment tree over the remaining capacities; if there is none, a window is
opened.

Only the last windows of a group stay far from full.  Windows with more than
``SLACK`` tokens of padding are therefore dissolved, and their pieces packed
together with those of other groups in the next round, until one group holds
them all or a round no longer helps.  Rows are narrow (no text, no ids), a
group is one task's work whatever the table's size, and nothing passes the
driver but counts.

Defined results: null and empty texts are one token (the end id); repeated
rows are packed each for itself; very long texts are tokenised part by part;
ties in length go by doc_id (null first); an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.common import prepared, query, saved, table
from corpuslens.llm.packing import CAPACITY, TOKENIZER, token_pieces

END_ID = 1
#: pieces that one task packs together
GROUP = 1 << 16
#: padding that a finished window may have, in tokens
SLACK = 4
#: a round that finishes a smaller share of its windows is the last
WORTHWHILE = 0.2

_PLACED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, room int"


class OpenWindows:
    """Open windows by remaining capacity, under a segment tree.

    A leaf stands for a capacity and counts its open windows; an inner node
    has the sum of its leaves, so the tightest window that holds a piece is
    found by one way up and one down.
    """

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.open = [0] * (2 * self.leaves)
        self.windows = [[] for _ in range(capacity + 1)]

    def _add(self, capacity: int, n: int):
        node = self.leaves + capacity
        while node:
            self.open[node] += n
            node >>= 1

    def put(self, window: int, capacity: int):
        if capacity:
            self.windows[capacity].append(window)
            self._add(capacity, 1)

    def take(self, size: int) -> tuple[int, int] | None:
        """(window, capacity) of the tightest window that holds ``size``."""
        tree, node = self.open, self.leaves + size
        while not tree[node]:
            # the next subtree to the right; none if the node is on the right edge
            while node & 1:
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.leaves:
            node *= 2
            if not tree[node]:
                node += 1
        capacity = node - self.leaves
        self._add(capacity, -1)
        return self.windows[capacity].pop(), capacity


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Window and offset of every size, and the room left in every window.
    ``sizes`` are packed from large to small, equal ones in their order."""
    tree, room = OpenWindows(capacity), []
    window, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        found = tree.take(size)
        if found is None:
            found = len(room), capacity
            room.append(capacity)
        w, left = found
        window[i], offset[i] = w, capacity - left
        room[w] = left - size
        tree.put(w, left - size)
    return window, offset, np.array(room, np.int64)


def _pack_partition(capacity: int, turn: int):
    names = [c.split()[0] for c in _PLACED.split(", ")]

    def run(batches):
        held, groups = [], 0

        def flush():
            t = pa.Table.from_batches(held)
            # one order for equal input, whatever order the rows came in
            t = t.sort_by([(c, "ascending") for c in ("doc_id", "start", "ids_crc32", "length", "doc_tokens")])
            window, offset, room = best_fit_decreasing(t.column("length").to_numpy(), capacity)
            base = (turn << 56) + (task << 28) + (groups * GROUP)
            t = (t.append_column("sequence_id", pa.array(base + window))
                 .append_column("offset", pa.array(offset)).append_column("room", pa.array(room[window].astype(np.int32))))
            return t.select(names).combine_chunks().to_batches()

        task = None
        for b in batches:
            if b.num_rows and task is None:
                task = b.column("task")[0].as_py()
            b = b.drop_columns(["task"])
            while sum(x.num_rows for x in held) + b.num_rows >= GROUP:
                cut = GROUP - sum(x.num_rows for x in held)
                held.append(b.slice(0, cut))
                b = b.slice(cut)
                yield from flush()
                held, groups = [], groups + 1
            if b.num_rows:
                held.append(b)
        if held:
            yield from flush()
    return run


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, slack: int = SLACK) -> DataFrame:
    """``pieces(doc_id, start, length, ids_crc32, doc_tokens)`` plus
    sequence_id and offset; full windows stand alone."""
    prepared(pieces.sparkSession)
    pieces = saved(pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens"))
    done = [pieces.filter(F.col("length") >= capacity).withColumns(
        {"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})]
    open_pieces = pieces.filter(F.col("length") < capacity)
    left, turn = open_pieces.count(), 0
    while left:
        turn += 1
        groups = -(-left // (GROUP * 7 // 8))  # the deal is even but for a few rows
        dealt = open_pieces.repartition(groups).withColumn("task", F.spark_partition_id())
        placed = saved(dealt.mapInArrow(_pack_partition(capacity, turn), _PLACED))
        finished = F.col("room") <= slack
        loose, unfinished = placed.agg(F.count(F.when(~finished, 1)),
                                       F.count(F.when(~finished & (F.col("offset") == 0), 1))).first()
        windows = placed.filter("offset = 0").count() if groups > 1 else 0
        if groups == 1 or windows - unfinished < WORTHWHILE * windows:
            done.append(placed.drop("room"))
            break
        done.append(placed.filter(finished).drop("room"))
        open_pieces, left = placed.filter(~finished).select(*pieces.columns), loose
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def pack(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY, end_id: int = END_ID,
         slack: int = SLACK) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    return pack_pieces(token_pieces(docs, tokenizer, capacity, end_id=end_id), capacity, slack)


@query("op13_best_fit_decreasing")
def op13_best_fit_decreasing(spark, sf_dir):
    """All documents in sequences of at most 2048 tokens."""
    return pack(table(spark, sf_dir, "documents"))
