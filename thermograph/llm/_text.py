"""Vectorised word splitting and hashing over Arrow string columns.

The functions work on the UTF-8 buffer of a whole slice of documents at once,
so a Python task spends a few nanoseconds per byte and never loops over words.
A slice holds whole documents: a text is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
# A slice holds documents up to this many bytes (one longer text is a slice).
SLICE_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finalising permutation of splitmix64."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
_BYTE[_SPACE] = 0
_STEP = U64(0xD6E8FEB86659FD93)


def powers(n: int, base=_STEP) -> np.ndarray:
    """1, b, b**2, ... modulo 2**64."""
    out = np.full(max(n, 1), base, dtype=U64)
    out[0] = 1
    return np.cumprod(out, dtype=U64)


def text_slices(col, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int, pa.Array]]:
    """(first row, last row + 1, strings) of consecutive rows whose texts hold
    at most ``max_bytes`` together; nulls are read as empty texts."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string()).fill_null("")
    off = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    i = 0
    while i < len(col):
        j = int(np.searchsorted(off, off[i] + max_bytes, side="right")) - 1
        j = min(max(j, i + 1), len(col))
        yield i, j, col.slice(i, j - i)
        i = j
    # Workers live on between stages; what a batch needed goes back.
    del col, off
    pa.default_memory_pool().release_unused()


class Words:
    """Words (maximal runs without ASCII white space) of a slice of texts.

    ``raw``: the bytes as they are, ``buf``: as asked for (lower-cased A-Z, or
    mapped by a table of 256 bytes, where words end at a space); ``start``/``end``: byte offsets of words; ``doc``: the row of each;
    ``first``: index of the first word of each row, plus the total."""

    def __init__(self, texts: pa.Array, lower: bool = False, table: np.ndarray | None = None):
        n = len(texts)
        off = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + n + 1]
        data = texts.buffers()[2]
        raw = (np.frombuffer(data, dtype=np.uint8)[off[0]:off[-1]] if data is not None
               else np.zeros(0, np.uint8))
        self.raw = raw
        self.off = off - off[0]
        self.buf = table[raw] if table is not None else _LOWER[raw] if lower else raw
        word = ~_SPACE[self.buf]
        edge = np.zeros(len(raw) + 1, dtype=bool)
        edge[self.off] = True
        begin = word.copy()
        begin[1:] &= ~word[:-1] | edge[1:-1]
        stop = word.copy()
        stop[:-1] &= ~word[1:] | edge[1:-1]
        self.start = np.flatnonzero(begin)
        self.end = np.flatnonzero(stop) + 1
        self.first = np.searchsorted(self.start, self.off)
        self.doc = np.repeat(np.arange(n), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        if not len(self.start):
            return np.zeros(0, U64)
        # Each word's segment reaches to the next word; white space counts zero.
        low = self.start[0]
        begin = self.start - low
        segment = np.diff(begin, append=len(self.buf) - low)
        inside = np.arange(len(self.buf) - low, dtype=np.int32)
        inside -= np.repeat(begin.astype(np.int32), segment)
        length = self.end - self.start
        most = int(length.max())
        if int(segment.max()) > most:
            np.minimum(inside, most - 1, out=inside)
        value = _BYTE[self.buf[low:]]
        value *= powers(most)[inside]
        return mix(np.add.reduceat(value, begin) + length.astype(U64) * U64(0xA24BAED4963EE407))


def windows(h: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first word's index) of every run of ``k`` words inside one row."""
    if len(h) < k:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    at = np.flatnonzero(doc[k - 1:] == doc[:len(doc) - k + 1])
    q = powers(k, U64(0x9FB21C651E98DF25))
    out = np.zeros(len(at), U64)
    for j in range(k):
        out += h[at + j] * q[j]
    return mix(out), at


def distinct_pairs(group: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (group, value), sorted by value within each group; ``group`` is
    sorted."""
    v = value.copy()
    edges = np.flatnonzero(group[1:] != group[:-1]) + 1 if len(group) else group
    for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(v)], strict=True):
        v[a:b].sort()
    keep = np.ones(len(v), bool)
    keep[1:] = (group[1:] != group[:-1]) | (v[1:] != v[:-1])
    return group[keep], v[keep]


def shingle_sets(words: Words, n_rows: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, shingle hash), distinct and sorted: the k-word shingles of each
    row; a row of fewer than ``k`` words has its whole sequence as one; a row
    without words has none."""
    h = words.hashes()
    value, at = windows(h, words.doc, k)
    group = words.doc[at]
    count = np.diff(words.first)
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        member = (count[words.doc] < k)
        inside = np.arange(len(h)) - words.first[words.doc]
        q = powers(k, U64(0x9FB21C651E98DF25))
        part = np.where(member, h * q[np.minimum(inside, k - 1)], U64(0))
        whole = np.add.reduceat(part, words.first[short]) if len(part) else part
        # reduceat sums up to the next short row; rows between contribute zero.
        whole = mix(whole ^ (count[short].astype(U64) * U64(0xC2B2AE3D27D4EB4F)))
        group = np.concatenate((group, short))
        value = np.concatenate((value, whole))
        order = np.argsort(group, kind="stable")
        group, value = group[order], value[order]
    return distinct_pairs(group, value)
