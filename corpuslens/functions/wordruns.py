r"""Words of many texts at once: whole Arrow arrays, without a string per word.

What ``segment`` defines as patterns is found here on the code points of all
texts of an Arrow batch together: a word is a run of letters, its letters are
cut out of the buffer, and Arrow numbers the distinct ones.  The texts must
be lower-cased already (Spark does that), so both forms agree.
"""

from __future__ import annotations

import functools
import hashlib
import sys
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_LATIN = [(0x41, 0x5A), (0x61, 0x7A), (0xC0, 0x24F)]


@functools.cache
def latin() -> np.ndarray:
    """Which code points ``segment.WORD_PATTERN`` matches."""
    table = np.zeros(sys.maxunicode + 2, bool)
    for first, last in _LATIN:
        table[first:last + 1] = True
    return table


@functools.cache
def letters() -> np.ndarray:
    r"""Which code points \p{L} matches."""
    table = np.zeros(sys.maxunicode + 2, bool)
    table[:-1] = [unicodedata.category(chr(i))[0] == "L" for i in range(sys.maxunicode + 1)]
    return table


#: stands behind every text, so that nothing runs across two of them; no
#: word or sentence holds it
_END = "\n"


def _plain(texts) -> pa.Array:
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    return pc.fill_null(texts.cast(pa.large_string()), "")


def code_points(texts) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, an end mark behind each, and each text's
    number of them with its mark."""
    texts = _plain(texts)
    sizes = pc.utf8_length(texts).to_numpy().astype(np.int64)
    ended = pc.binary_join_element_wise(texts, pa.scalar("", texts.type), pa.scalar(_END, texts.type))
    body = ended.buffers()[2] if len(texts) else None
    stops = np.frombuffer(ended.buffers()[1], np.int64, len(texts) + 1, 8 * ended.offset) if len(texts) else [0]
    raw = body.slice(stops[0], stops[-1] - stops[0]) if body is not None else b""
    return np.frombuffer(str(raw, "utf-8").encode("utf-32-le"), np.uint32), sizes + 1


def _runs(mark: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs of True start and stop; the last entry is False."""
    edge = np.flatnonzero(mark[1:] != mark[:-1]) + 1
    if len(mark) and mark[0]:
        edge = np.concatenate([[0], edge])
    return edge[::2], edge[1::2]


@functools.cache
def _letter_numbers(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 64, sys.maxunicode + 2, np.uint64)


#: an odd factor and its inverse modulo 2^64
_FACTOR = 0x9E3779B97F4A7C15
_BACK = pow(_FACTOR, -1, 1 << 64)
#: longer words are hashed by themselves
_LONG = 256


#: powers that this worker has worked out
_POWERS: dict[int, np.ndarray] = {}


def _powers(factor: int, n: int) -> np.ndarray:
    """1, factor, factor^2, ... modulo 2^64, ``n`` of them."""
    if len(_POWERS.get(factor, ())) < n:
        out = np.full(-(-n // (1 << 17)) << 17, factor, np.uint64)
        out[0] = 1
        _POWERS[factor] = np.cumprod(out)
    return _POWERS[factor][:n]


def word_numbers(points: np.ndarray, sizes: np.ndarray, table: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit number for every run of code points of ``table``, in order,
    and how many runs each text has.

    Equal words have equal numbers.  That different ones differ is for the
    caller to check on its vocabulary (``vectors.sent_idf`` does)."""
    mark = table[points]
    first, stop = _runs(mark)
    upto = np.zeros(len(points) + 1, np.uint64)
    np.cumsum(_letter_numbers(seed)[points] * _powers(_FACTOR, len(points)), out=upto[1:])
    out = (upto[stop] - upto[first]) * _powers(_BACK, len(points))[first]
    for i in np.flatnonzero(stop - first > _LONG):
        word = points[first[i]:stop[i]].tobytes()
        out[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8, salt=seed.to_bytes(8, "little")).digest(), "little")
    return out.view(np.int64), per_text(first, sizes)


def words(points: np.ndarray, sizes: np.ndarray, table: np.ndarray, least: int = 1) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All runs of at least ``least`` code points of ``table``, in order, as
    strings; how many each text has; and their code points."""
    mark = table[points]
    first, stop = _runs(mark)
    if least > 1:
        short = stop - first < least
        for a, b in ((first[short], stop[short]),):
            drop = np.zeros(len(points) + 1, np.int8)
            drop[a], drop[b] = 1, -1
            mark &= ~np.cumsum(drop[:-1]).astype(bool)
        first, stop = first[~short], stop[~short]
    long = stop - first
    text = points[mark]
    body = text.tobytes().decode("utf-32-le").encode()
    at = np.concatenate([[0], np.cumsum(long)])
    # UTF-8 takes a byte more for every code point beyond each of these
    at = at + sum(np.searchsorted(np.flatnonzero(text > most), at) for most in (0x7F, 0x7FF, 0xFFFF))
    found = pa.LargeStringArray.from_buffers(len(long), pa.py_buffer(at.astype(np.int64).tobytes()), pa.py_buffer(body))
    return found, per_text(first, sizes), long


def per_text(places: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How many of ``places`` (in order) lie in each text."""
    return np.diff(np.searchsorted(places, np.cumsum(sizes)), prepend=0).astype(np.int64)


@functools.cache
def _marked(chars: str) -> np.ndarray:
    """Which code points are one of ``chars``."""
    table = np.zeros(sys.maxunicode + 2, bool)
    table[[ord(c) for c in chars]] = True
    return table


def vowel_groups(points: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``segment.vowel_groups`` of every text."""
    first, _ = _runs(_marked("aeiouy")[points])
    return per_text(first, sizes)


def sentences(points: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How many ``segment.sentences`` every text has: runs without a mark
    that end in one or are not all spaces."""
    inside = ~_marked(".!?\n")[points]
    first, stop = _runs(inside)
    kept = (points[first] != ord(" ")) | (points[stop] != ord("\n"))
    if not kept.all():
        filled = np.concatenate([[0], np.cumsum(inside & (points != ord(" ")))])
        kept |= filled[stop] > filled[first]
    return per_text(first[kept], sizes)


def numbered(found: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """A number for every word, and the distinct words."""
    d = found.dictionary_encode()
    return d.indices.to_numpy().astype(np.int64), d.dictionary


_LOW = (1 << 32) - 1


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Pairs of numbers below 2^31 as one number each."""
    return (a.astype(np.int64) << 32) | b


def parts(pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return pair >> 32, pair & _LOW


def counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct numbers in order and how often each occurs."""
    values = np.sort(values)
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    at = np.flatnonzero(new)
    return values[at], np.diff(np.append(at, len(values)))


#: code points that are worked on together; a worker's arrays are some
#: hundred bytes for each
BLOCK = 1 << 18


def blocks(sizes: np.ndarray, most: int | None = None):
    """Ranges of rows whose sizes add up to ``most`` (``BLOCK``), one row at least."""
    most = most or BLOCK
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + most, "right")))
        yield start, stop
        start = stop


def distinct(lowered: pa.Array) -> pa.Array:
    """The distinct words of every text (null: none), as lists."""
    lists = []
    for i, j in blocks(pc.fill_null(pc.utf8_length(lowered), 0).to_numpy(zero_copy_only=False)):
        found, n, _ = words(*code_points(lowered.slice(i, j - i)), latin())
        code, names = numbered(found)
        row, code = parts(counted(joined(np.repeat(np.arange(j - i), n), code))[0])
        at = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=j - i))])
        lists.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), names.take(pa.array(code)).cast(pa.string())))
    return pa.concat_arrays(lists) if lists else pa.array([], pa.list_(pa.string()))
