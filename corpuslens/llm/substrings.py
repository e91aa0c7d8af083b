"""Removal of repeated substrings by a distributed sparse suffix array.

Goal: every byte covered by a ``SPAN``-byte string that also starts in a
document with a smaller doc_id is removed.

1. Partitioning.  In each window of SPAN bytes the gram of ``GRAM`` bytes with
   the smallest hash is its anchor.  Equal windows have equal anchors at equal
   places, so the suffixes that start at the windows of one anchor can be
   dealt to partitions by the anchor's hash, and only these need comparing
   with one another.  A run of windows with one anchor is one record: anchor
   hash, hash of the run's bytes, document, place.  A task first combines what
   it holds: of equal runs only those of the smallest document go on, the
   others are already known to be repeats.
2. Per partition, anchors that only one document has end here.  Equal runs are
   one block of suffixes; where an anchor has a single block, its order is
   trivial.  Blocks of anchors that have several are fetched from the texts.
3. Their suffixes are sorted deep-shallow: multikey quicksort over 8-byte
   characters down to a shallow depth; groups that still agree there, the ones
   with long common prefixes, are ordered by blind tries, which keep branching
   depths and bytes only.  Neighbours with SPAN bytes in common are repeats; the
   smallest document keeps its copy.
4. The spans of a document are merged and cut out of its bytes.

An anchor with very many blocks is dealt out by the content of its windows
instead, so no anchor lands in one task whole.  Equal windows are combined
before they are dealt, and sorted in chunks that hand on the smallest
document's, so no window is held as often as it occurs.

Defined results: null text counts as empty; rows without doc_id are left as
they are; rows that share a doc_id don't remove from each other, and each
loses what any of them repeats at that place; texts under SPAN bytes are
kept; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.common import BROADCAST_BYTES, empty_if_null, prepared, query, runs, saved, table
from corpuslens.session import scratch_dir

SPAN, GRAM = 50, 24
#: bytes a task works on at a time, and records it combines before it sends them
CHUNK, FLUSH = 1 << 20, 1 << 19
#: bytes of text for one partition of anchors
PARTITION_BYTES = 16 << 20
#: blocks of one anchor beyond which its windows are dealt out one by one
HOT_BLOCKS = 1 << 14
#: windows of such anchors that a task combines before it sends them
HELD = 1 << 15
#: rows that are sorted at once, if a route has no more
SORTED = 1 << 14
#: multikey quicksort: characters of 8 bytes until blind tries take over
SHALLOW = 2
SMALL = 48

_BASE = 0x9E3779B97F4A7C15
_MASK64 = (1 << 64) - 1
_BYTES = np.random.default_rng(50).integers(1, 1 << 63, 256, dtype=np.uint64)
_SPLIT = "part int, kind int, doc_id long, at int, size int, body binary"
_FOUND = "kind int, doc_id long, at int, size int, route long"


def _mixed(h):
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def _gram_hashes(x: np.ndarray, k: int) -> np.ndarray:
    """Polynomial hash of every k-gram of bytes, by doubling."""
    out, have, power, width = None, 0, x, 1
    while True:
        if k & width:
            if out is None:
                out = power
            else:
                n = min(len(out), len(power) - have)
                out = out[:n] * np.uint64(pow(_BASE, width, 1 << 64)) + power[have:have + n]
            have += width
        if width * 2 > k:
            return out[:len(x) - k + 1]
        power = power[:-width] * np.uint64(pow(_BASE, width, 1 << 64)) + power[width:]
        width *= 2


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    width, n = 1, len(x) - w + 1
    while width * 2 <= w:
        x = np.minimum(x[:-width], x[width:])
        width *= 2
    return np.minimum(x[:n], x[w - width:w - width + n]) if width < w else x[:n]


_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict = {}


def _powers(n):
    if len(_POWERS.get("up", ())) < n:
        size = max(n, CHUNK + SPAN)
        up = np.full(size, _BASE, np.uint64)
        down = np.full(size, _INVERSE, np.uint64)
        up[0] = down[0] = 1
        _POWERS["up"], _POWERS["down"] = np.cumprod(up), np.cumprod(down)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def window_runs(pieces: list[bytes], span: int = SPAN, gram: int = GRAM):
    """Runs of windows with one anchor, over all pieces: (piece, first
    window, further windows, anchor hash, hash of the run's bytes)."""
    buf = b"".join(pieces)
    size = np.fromiter(map(len, pieces), np.int64, len(pieces))
    none = np.zeros(0, np.int64)
    if len(buf) < span:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    x = _BYTES[np.frombuffer(buf, np.uint8)]
    h = _mixed(_gram_hashes(x, gram))
    bits = np.uint64(len(buf).bit_length())
    low = (np.uint64(1) << bits) - np.uint64(1)
    # leftmost of the smallest hashes
    least = _sliding_min((h & ~low) | np.arange(len(h), dtype=np.uint64), span - gram + 1)
    anchor = (least & low).astype(np.int64)
    end = np.cumsum(size)
    piece = np.repeat(np.arange(len(pieces)), size)[:len(anchor)]
    inside = np.arange(len(anchor)) + span <= end[piece]
    at = np.flatnonzero(inside)
    if len(at) == 0:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    a = anchor[at]
    fresh = np.concatenate([[True], (a[1:] != a[:-1]) | (at[1:] != at[:-1] + 1) | (piece[at[1:]] != piece[at[:-1]])])
    start, length = runs(np.cumsum(fresh))
    first, more = at[start], length - 1
    up, down = _powers(len(x))
    total = np.concatenate([[np.uint64(0)], np.cumsum(x * up)])
    stop = first + more + span
    body = (total[stop] - total[first]) * down[first]
    where = (a[start] - first).astype(np.uint64)
    body = _mixed(body + where * np.uint64(0xD6E8FEB86659FD93) + more.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    return piece[first], first - (end - size)[piece[first]], more, h[a[start]], body


def _pieces(doc_ids, bodies, span):
    """Chunks of (document, offset, bytes); long texts are cut so that every
    window lies in one piece."""
    chunk, held = [], 0
    for doc, body in zip(doc_ids, bodies, strict=True):
        if doc is None or len(body) < span:
            continue
        for at in range(0, len(body) - span + 1, CHUNK):
            part = body[at:at + CHUNK + span - 1]
            if chunk and held + len(part) > CHUNK + span:
                yield chunk
                chunk, held = [], 0
            chunk.append((doc, at, part))
            held += len(part)
    if chunk:
        yield chunk


def _planes(x: np.ndarray) -> bytes:
    """Little-endian integers as byte planes, which compress well."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes()


def _unplanes(raw: bytes, kind, n: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(-1, n).T).view(kind).ravel()


def _encode(key, body, doc, at, more) -> bytes:
    """Records sorted by (document, place)."""
    ids, count = np.unique(doc, return_counts=True)
    step = np.diff(at, prepend=0).astype(np.int32)
    head = np.array([len(key), len(ids)], np.int64).tobytes()
    # with the anchor's hash and its partition, 6 bytes tell the runs apart
    short = np.ascontiguousarray(body).view(np.uint8).reshape(-1, 8)[:, :6]
    return b"".join([head, _planes(ids), _planes(count.astype(np.int32)), _planes(step), more.astype(np.uint8).tobytes(),
                     key.tobytes(), short.tobytes()])


def _decode(raw: bytes):
    n, m = np.frombuffer(raw, np.int64, 2)
    sizes = np.array([8 * m, 4 * m, 4 * n, n, 4 * n, 6 * n])
    cut = 16 + np.concatenate([[0], np.cumsum(sizes)])
    part = [raw[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]
    doc = np.repeat(_unplanes(part[0], np.int64, m), _unplanes(part[1], np.int32, m))
    at = np.cumsum(_unplanes(part[2], np.int32, n)).astype(np.int32)
    body = np.zeros((n, 8), np.uint8)
    body[:, :6] = np.frombuffer(part[5], np.uint8).reshape(-1, 6)
    return (np.frombuffer(part[4], np.uint32), body.view(np.uint64).ravel(), doc, at, np.frombuffer(part[3], np.uint8))


def _batch(part, kind, doc, at, size, body):
    n = len(part)
    null = pa.nulls(n)
    return pa.RecordBatch.from_arrays([
        pa.array(part, pa.int32()), pa.array(kind, pa.int32()),
        null.cast(pa.int64()) if doc is None else pa.array(doc, pa.int64()),
        null.cast(pa.int32()) if at is None else pa.array(at, pa.int32()),
        null.cast(pa.int32()) if size is None else pa.array(size, pa.int32()),
        pa.array([None] * n if body is None else body, pa.binary())], ["part", "kind", "doc_id", "at", "size", "body"])


def _merged_spans(doc, at, size):
    """Spans of one task, merged where they touch, some at a time."""
    order = np.lexsort((at, doc))
    doc, at = doc[order], at[order].astype(np.int64)
    doc, at, stop = merged(doc, at, at + size[order])
    for i in range(0, len(doc), 1 << 16):
        p = slice(i, i + (1 << 16))
        yield doc[p], at[p], stop[p] - at[p]


def _found(kind, doc, at, size, route=None):
    n = len(doc)
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(n, kind), pa.int32()), pa.array(doc, pa.int64()), pa.array(at, pa.int32()),
        pa.array(size, pa.int32()), pa.nulls(n, pa.int64()) if route is None else pa.array(route, pa.int64())],
        ["kind", "doc_id", "at", "size", "route"])


def merged(doc, at, stop):
    """Union of spans sorted by (document, start)."""
    if len(doc) == 0:
        return doc, at, stop
    group = np.concatenate([[0], np.cumsum(doc[1:] != doc[:-1])])
    width = int(stop.max()) + 1
    # a running maximum that can't reach from one document into the next
    reach = np.maximum.accumulate(stop + group * width) - group * width
    fresh = np.concatenate([[True], (group[1:] != group[:-1]) | (at[1:] > reach[:-1])])
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], at[first], reach[last]


def _anchors(parts, span, gram):
    def run(batches):
        held, n = [], 0

        def flush():
            key, body, doc, at, more = (np.concatenate(c) for c in zip(*held, strict=True))
            order = np.lexsort((doc, key, body))
            same = np.concatenate([[False], (key[order][1:] == key[order][:-1]) & (body[order][1:] == body[order][:-1])])
            start, length = runs(np.cumsum(~same))
            repeat = np.zeros(len(doc), bool)
            repeat[order] = doc[order] > np.repeat(doc[order][start], length)
            for d, a, n in _merged_spans(doc[repeat], at[repeat], more[repeat].astype(np.int64) + span):
                yield _batch((d * 40503 + a // 4096) % parts, np.ones(len(d), int), d, a, n, None)
            keep = np.flatnonzero(~repeat)
            part = ((key[keep] >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
            order = np.lexsort((at[keep], doc[keep], part))
            keep, part = keep[order], part[order]
            start, length = runs(part)
            for s, k in zip(start, length, strict=True):
                i = keep[s:s + k]
                yield _batch([part[s]], [0], None, None, None, [_encode(
                    (key[i] & np.uint64(0xFFFFFFFF)).astype(np.uint32), body[i], doc[i], at[i], more[i])])

        for b in batches:
            for chunk in _pieces(b.column("doc_id").to_pylist(), b.column("body").to_pylist(), span):
                piece, first, more, key, body = window_runs([c[2] for c in chunk], span, gram)
                doc = np.array([c[0] for c in chunk], np.int64)[piece]
                at = (np.array([c[1] for c in chunk], np.int64)[piece] + first).astype(np.int32)
                held.append((key, body, doc, at, more.astype(np.uint8)))
                n += len(key)
                if n >= FLUSH:
                    yield from flush()
                    held, n = [], 0
        if n:
            yield from flush()
    return run


def _blocks(span):
    """Per partition: spans of equal runs (kind 1), and the blocks whose
    suffixes have to be sorted (kind 2; 3: of an anchor with very many)."""
    def run(batches):
        got, part = [], 0
        for b in batches:
            kind = b.column("kind").to_numpy()
            part = int(b.column("part")[0].as_py())
            if (kind == 1).any():
                own = b.filter(pa.array(kind == 1))
                yield _found(1, *(own.column(c).to_numpy() for c in ("doc_id", "at", "size")))
            got += [_decode(x) for x in b.column("body").filter(pa.array(kind == 0)).to_pylist()]
        if not got:
            return
        key, body, doc, at, more = (np.concatenate(c) for c in zip(*got, strict=True))
        del got
        order = np.lexsort((doc, body, key))
        key, body, doc, at, more = (c[order] for c in (key, body, doc, at, more))
        fresh_key = np.concatenate([[True], key[1:] != key[:-1]])
        fresh = fresh_key.copy()
        fresh[1:] |= body[1:] != body[:-1]
        start, length = runs(np.cumsum(fresh))
        low = np.repeat(doc[start], length)
        repeat = doc > low
        for spans in _merged_spans(doc[repeat], at[repeat], more[repeat].astype(np.int64) + span):
            yield _found(1, *spans)
        k_start, k_length = runs(np.cumsum(fresh_key))
        several = np.add.reduceat(fresh.astype(np.int64), k_start)
        low_doc, high_doc = np.minimum.reduceat(doc, k_start), np.maximum.reduceat(doc, k_start)
        asked = np.repeat((several > 1) & (low_doc < high_doc), k_length) & ~repeat
        hot = np.repeat(several > HOT_BLOCKS, k_length)
        i = np.flatnonzero(asked)
        route = (key[i].astype(np.int64) << 8) ^ part
        for kind, of in ((2, ~hot[i]), (3, hot[i])):
            for j in range(0, int(of.sum()), 1 << 16):
                w = np.flatnonzero(of)[j:j + (1 << 16)]
                yield _found(kind, doc[i[w]], at[i[w]], more[i[w]].astype(np.int64) + span, route[w])
    return run


_CUT = "route long, doc_id long, at int, size int, body binary"


def _cut_blocks(span):
    """Bytes of the asked blocks of every text, by the anchor's route.  Of
    equal windows that are dealt out one by one a task sends those of the
    smallest document; the others are spans already (without a body)."""
    def run(batches):
        low, held = {}, 0

        def flush():
            rows = [(hash_of(w), doc, a, span, w) for w, (doc, places) in low.items() for a in places]
            if rows:
                yield _cut(*zip(*rows, strict=True))

        for b in batches:
            out, spans = [], []
            for doc, body, asked in zip(b.column("doc_id").to_pylist(), b.column("body").to_pylist(),
                                        b.column("asked").to_pylist(), strict=True):
                for q in asked:
                    a, n, route = q["at"], q["size"], q["route"]
                    block = body[a:a + n]
                    if len(block) < n:
                        continue  # another row of this doc_id
                    if q["kind"] == 2:
                        out.append((route, doc, a, n, block))
                        continue
                    for i in range(n - span + 1):
                        w = block[i:i + span]
                        first = low.setdefault(w, (doc, []))
                        if doc > first[0]:
                            spans.append((doc, a + i))
                            continue
                        if doc < first[0]:
                            spans += [(first[0], place) for place in first[1]]
                            held -= len(first[1])
                            first = low[w] = (doc, [])
                        first[1].append(a + i)
                        held += 1
                    if held >= HELD:
                        yield from flush()
                        low, held = {}, 0
            if out:
                yield _cut(*zip(*out, strict=True))
            if spans:
                doc, at = np.array(spans, np.int64).T
                for d, a, n in _merged_spans(doc, at, np.full(len(doc), span)):
                    yield _cut(d * 40503 + a // 4096, d, a, n, [None] * len(d))
        yield from flush()
    return run


def _cut(route, doc, at, size, body):
    return pa.RecordBatch.from_arrays(
        [pa.array(route, pa.int64()), pa.array(doc, pa.int64()), pa.array(at, pa.int32()), pa.array(size, pa.int32()),
         pa.array(body, pa.binary())], ["route", "doc_id", "at", "size", "body"])


def hash_of(body: bytes) -> int:
    import xxhash
    return xxhash.xxh64_intdigest(body) - (1 << 63)


class BlindTrie:
    """Orders strings of one length that share a prefix: inner nodes hold a
    depth and branch by the byte there; bytes in between are not kept."""

    def __init__(self, text, depth: int, span: int):
        self.text, self.depth, self.span, self.root = text, depth, span, None

    def add(self, i: int) -> None:
        text, span = self.text, self.span
        if self.root is None:
            self.root = [i]
            return
        # blind descent to a leaf that agrees on all branching bytes it meets
        node, path = self.root, []
        while isinstance(node, tuple):
            path.append(node)
            at, kids = node
            byte = text[i + at]
            node = kids[byte] if byte in kids else next(iter(kids.values()))
        j = node[0]
        a, b = text[i + self.depth:i + span], text[j + self.depth:j + span]
        if a == b:
            node.append(i)
            return
        lo, hi = 0, len(a)
        while hi - lo > 1:  # first difference
            mid = (lo + hi) // 2
            if a[:mid] == b[:mid]:
                lo = mid
            else:
                hi = mid
        depth = self.depth + lo
        # the edge on which the strings part
        parent, child = None, self.root
        for above in path:
            if above[0] >= depth:
                break
            parent, child = above, above[1].get(text[i + above[0]])
        if isinstance(child, tuple) and child[0] == depth:
            child[1][text[i + depth]] = [i]
            return
        fork = (depth, {text[j + depth]: child, text[i + depth]: [i]})
        if parent is None:
            self.root = fork
        else:
            parent[1][text[i + parent[0]]] = fork

    def leaves(self):
        """Groups of equal strings, in order."""
        stack = [] if self.root is None else [self.root]
        while stack:
            node = stack.pop()
            if isinstance(node, tuple):
                stack += [node[1][b] for b in sorted(node[1], reverse=True)]
            else:
                yield node


def deep_shallow(text: bytes, suffixes: np.ndarray, span: int):
    """Sort the ``suffixes`` (places in ``text`` with ``span`` bytes each) by
    their first ``span`` bytes; yields groups of equal ones in order."""
    raw = np.frombuffer(text, np.uint8)
    depth = min(SHALLOW, span // 8)
    chars = []
    for c in range(depth):
        v = np.zeros(len(suffixes), np.uint64)
        for k in range(8):
            v = v << np.uint64(8) | raw[suffixes + (8 * c + k)].astype(np.uint64)
        chars.append(v)
    stack = [(np.arange(len(suffixes)), 0)]
    while stack:
        idx, c = stack.pop()
        if len(idx) == 1:
            yield suffixes[idx].tolist()
        elif c == depth:
            trie = BlindTrie(text, 8 * depth, span)
            for i in suffixes[idx].tolist():
                trie.add(i)
            yield from trie.leaves()
        elif len(idx) <= SMALL:
            # a short range: by its remaining shallow characters at once
            keys = sorted(zip(*(ch[idx].tolist() for ch in chars[c:]), idx.tolist(), strict=True))
            i = 0
            while i < len(keys):
                j = i + 1
                while j < len(keys) and keys[j][:-1] == keys[i][:-1]:
                    j += 1
                if j - i == 1:
                    yield [int(suffixes[keys[i][-1]])]
                else:
                    trie = BlindTrie(text, 8 * depth, span)
                    for k in keys[i:j]:
                        trie.add(int(suffixes[k[-1]]))
                    yield from trie.leaves()
                i = j
        else:
            v = chars[c][idx]
            pivot = np.sort(v[[0, len(v) // 2, -1]])[1]
            below, above = v < pivot, v > pivot
            # ternary split; popped in order
            for part, deeper in ((idx[above], c), (idx[~below & ~above], c + 1), (idx[below], c)):
                if len(part):
                    stack.append((part, deeper))


def repeated(doc: np.ndarray, blocks: list[bytes], span: int = SPAN):
    """(block, place in it) of every window that a smaller document has too."""
    size = np.fromiter(map(len, blocks), np.int64, len(blocks))
    base = np.cumsum(size) - size
    windows = size - span + 1
    owner = np.repeat(np.arange(len(blocks)), windows)
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    suffixes = base[owner] + inner
    text = b"".join(blocks)
    place = np.zeros(len(text), np.int64)
    place[suffixes] = np.arange(len(suffixes))
    found = []
    for group in deep_shallow(text, suffixes, span):
        if len(group) > 1:
            w = place[group]
            d = doc[owner[w]]
            found.append(w[d > d.min()])
    w = np.concatenate(found) if found else np.zeros(0, np.int64)
    return owner[w], inner[w]


def _sorted_suffixes(span):
    """Blocks sorted by route: whole routes, some at a time.  A route with
    more rows is sorted in chunks; the blocks that still have a window of the
    smallest document so far go on to its next chunk."""
    def run(batches):
        held, n, rest, most = [], 0, None, 2 * SORTED

        def settle():
            """Yields spans, then the rows that aren't repeats as a whole."""
            table_ = pa.Table.from_batches(held).combine_chunks()
            doc, at = table_.column("doc_id").to_numpy(), table_.column("at").to_numpy().astype(np.int64)
            blocks = table_.column("body").to_pylist()
            owner, inner = repeated(doc, blocks, span)
            for spans in _merged_spans(doc[owner], at[owner] + inner, np.full(len(owner), span)):
                yield _found(1, *spans)
            fresh = np.fromiter(map(len, blocks), np.int64, len(blocks)) - span + 1
            fresh -= np.bincount(owner, minlength=len(blocks))
            left[:] = table_.filter(pa.array(fresh > 0)).combine_chunks().to_batches()

        left: list = []
        for b in batches:
            known = b.column("body").is_null()
            if known.true_count:
                yield _found(1, *(b.filter(known).column(c).to_numpy() for c in ("doc_id", "at", "size")))
                b = b.filter(b.column("body").is_valid())
            while b is not None and len(b):
                route = b.column("route").to_numpy()
                if held and n >= SORTED and route[0] != rest:
                    yield from settle()
                    held, n, most = [], 0, 2 * SORTED
                # up to the last route that may go on in the next batch
                other = np.flatnonzero(route != route[-1])
                cut = other[-1] + 1 if len(other) else len(b)
                if n + cut > SORTED and len(other):
                    # settle at the first route border beyond the bound
                    border = np.flatnonzero(route[1:cut] != route[:cut - 1]) + 1
                    border = border[border + n >= SORTED]
                    cut = int(border[0]) if len(border) else cut
                held.append(b.slice(0, cut))
                n += cut
                rest = route[cut - 1]
                b = b.slice(cut) if cut < len(b) else None
                if n >= most:
                    yield from settle()
                    held, n = list(left), sum(map(len, left))
                    # few were repeats: not to sort the same rows again and again
                    most = max(2 * SORTED, 2 * n)
        if held:
            yield from settle()
    return run


def _merge_spans(batches):
    """Spans sorted by (doc_id, at) -> one row per document."""
    doc = at = stop = np.zeros(0, np.int64)

    def out(doc, at, stop):
        start, length = runs(doc)
        pairs = np.stack([at, stop], 1).astype("<i4")
        return pa.RecordBatch.from_arrays([
            pa.array(doc[start], pa.int64()),
            pa.array([pairs[s:s + n].tobytes() for s, n in zip(start, length, strict=True)], pa.binary())],
            ["doc_id", "spans"])

    for b in batches:
        a = b.column("at").to_numpy().astype(np.int64)
        doc, at, stop = merged(np.concatenate([doc, b.column("doc_id").to_numpy()]), np.concatenate([at, a]),
                               np.concatenate([stop, a + b.column("size").to_numpy()]))
        cut = np.searchsorted(doc, doc[-1]) if len(doc) else 0
        if cut:
            yield out(doc[:cut], at[:cut], stop[:cut])
            doc, at, stop = doc[cut:], at[cut:], stop[cut:]
    if len(doc):
        yield out(doc, at, stop)


def _with(docs: DataFrame, extra: DataFrame, how: str, n: int, size: int) -> DataFrame:
    """``docs`` joined with per-document rows ``extra(doc_id, value)``, at most
    ``n`` of them with ``size`` bytes: by broadcast if that is little, else only
    the texts of documents in ``extra`` are shuffled, if their ids are little;
    else all are."""
    value = [c for c in extra.columns if c != "doc_id"][0]
    if n * 64 + size <= BROADCAST_BYTES:
        return docs.join(F.broadcast(extra), "doc_id", how)
    if how == "inner" or n * 32 > BROADCAST_BYTES:
        return docs.join(extra, "doc_id", how)
    ids = F.broadcast(extra.select("doc_id"))
    kind = extra.schema[value].dataType
    return (docs.join(ids, "doc_id", "left_semi").join(extra, "doc_id")
            .unionByName(docs.join(ids, "doc_id", "left_anti").withColumn(value, F.lit(None).cast(kind))))


def repeated_spans(docs: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """(doc_id, spans) for every document that repeats an earlier one: spans
    are pairs of 32-bit start and end, sorted and apart."""
    least = prepared(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), empty_if_null().cast("binary").alias("body"))
    total = texts.agg(F.sum(F.length("body").cast("long"))).first()[0] or 0
    parts = max(least, -(-total // PARTITION_BYTES))
    # several rows for most documents: kept as a table, which is far smaller than a checkpoint
    path = scratch_dir(docs.sparkSession, "repeats")
    (texts.mapInArrow(_anchors(parts, span, gram), _SPLIT).repartitionById(parts, "part")
     .mapInArrow(_blocks(span), _FOUND).write.parquet(path))
    found = docs.sparkSession.read.schema(_FOUND).parquet(path)
    n = found.filter("kind > 1").count()
    asked = found.filter("kind > 1").groupBy("doc_id").agg(
        F.collect_list(F.struct("kind", "at", "size", "route")).alias("asked"))
    blocks = (_with(texts, asked, "inner", n, 32 * n).select("doc_id", "body", "asked")
              .mapInArrow(_cut_blocks(span), _CUT))
    later = (blocks.repartition(parts, "route").sortWithinPartitions("route")
             .mapInArrow(_sorted_suffixes(span), _FOUND))
    every = found.filter("kind = 1").unionByName(later).select("doc_id", "at", "size")
    return saved(every.repartition(parts, "doc_id").sortWithinPartitions("doc_id", "at")
                 .mapInArrow(_merge_spans, "doc_id long, spans binary"))


def _cut_out(batches):
    for b in batches:
        out = {"doc_id": b.column("doc_id").to_pylist(), "n_bytes": [], "n_removed": [], "n_spans": [], "kept": []}
        for body, spans in zip(b.column("body").to_pylist(), b.column("spans").to_pylist(), strict=True):
            pairs = np.frombuffer(spans or b"", "<i4").reshape(-1, 2).clip(max=len(body)).tolist()
            pairs = [p for p in pairs if p[0] < p[1]]
            edge = [0, *[x for p in pairs for x in p], len(body)]
            kept = b"".join(body[a:z] for a, z in zip(edge[::2], edge[1::2], strict=True)) if pairs else body
            for k, v in zip(("n_bytes", "n_removed", "n_spans", "kept"),
                            (len(body), len(body) - len(kept), len(pairs), kept), strict=True):
                out[k].append(v)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_pydict({k: pa.array(v, t) for (k, v), t in zip(out.items(), kinds, strict=True)})


def without_repeats(docs: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the ``kept`` bytes of every row."""
    spans = repeated_spans(docs, span, gram)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), empty_if_null().cast("binary").alias("body"))
    n, size = spans.agg(F.count("*"), F.coalesce(F.sum(F.length("spans")), F.lit(0))).first()
    return (_with(texts, spans, "left", n, size).select("doc_id", "body", "spans")
            .mapInArrow(_cut_out, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"))


@query("op4_suffix_array_dedup")
def op4_suffix_array_dedup(spark, sf_dir):
    """Every document without the strings that earlier ones have."""
    return without_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
