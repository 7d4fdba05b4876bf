"""Whole-text statistics computed over Arrow batches without a loop over documents.

A batch of texts is looked at as one byte buffer.  Words, lines and windows are index
arrays into that buffer; equality of two words, lines or windows is equality of a 64-bit
polynomial hash of their bytes.  A *word* is a maximal run of bytes other than
``\\x20 \\x09-\\x0D``, which in UTF-8 are always characters of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
# Odd 64-bit multipliers of the mixing function and of the polynomials.
MIX_A, MIX_B, GOLDEN = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB), U64(0x9E3779B97F4A7C15)
BASE = 0x2545F4914F6CDD1D

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
SLICE_BYTES = 2 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose every output bit depends on every input bit."""
    x = x ^ (x >> U64(30))
    x = x * MIX_A
    x = x ^ (x >> U64(27))
    x = x * MIX_B
    return x ^ (x >> U64(31))


def _powers(n: int, base: int) -> np.ndarray:
    out = np.empty(n, U64)
    out[0] = 1
    if n > 1:
        out[1:] = U64(base)
        np.multiply.accumulate(out, out=out)
    return out


class _Powers:
    """Powers of BASE and of its inverse, grown on demand and kept for the worker's life."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, U64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = _powers(n, BASE), _powers(n, pow(BASE, -1, 1 << 64))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def spans_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of data[start:end] for every span; equal bytes give equal hashes wherever they lie."""
    up, down = _POWERS.get(len(data) + 1)
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * up[: len(data)], out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(U64) * GOLDEN)


class Texts:
    """Some whole texts as one buffer.  ``offset`` has one entry more than there are texts."""

    def __init__(self, data: np.ndarray, offset: np.ndarray) -> None:
        self.data, self.offset, self.n = data, offset, len(offset) - 1
        space = _SPACE[data] if len(data) else np.zeros(0, bool)
        edge = np.zeros(len(data) + 1, bool)
        edge[offset] = True
        word = ~space
        before = np.concatenate(([False], word[:-1])) if len(data) else word
        after = np.concatenate((word[1:], [False])) if len(data) else word
        self.word_start = np.flatnonzero(word & (~before | edge[:-1]))
        self.word_end = np.flatnonzero(word & (~after | edge[1:])) + 1
        #: index of each text's first word, with the number of words at the end
        self.word_offset = np.searchsorted(self.word_start, offset)
        self.n_words = np.diff(self.word_offset)
        self.word_doc = np.repeat(np.arange(self.n), self.n_words)
        self._word_hash: np.ndarray | None = None
        self.is_space = space

    @property
    def word_hash(self) -> np.ndarray:
        if self._word_hash is None:
            self._word_hash = spans_hash(self.data, self.word_start, self.word_end)
        return self._word_hash

    def count(self, flags: np.ndarray) -> np.ndarray:
        """Number of set flags (one per byte) in each text."""
        return per_part(flags, self.offset)

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, text, first word) of every window of ``width`` words within one text."""
        h = self.word_hash
        n = len(h) - width + 1
        if n <= 0:
            empty = np.zeros(0, np.int64)
            return np.zeros(0, U64), empty, empty
        first = np.flatnonzero(self.word_doc[:n] == self.word_doc[width - 1 :])
        acc = h[first]
        for k in range(1, width):
            acc = acc * MIX_B + h[first + k]
        return mix(acc), self.word_doc[first], first

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, text) of every line that holds a word; lines end at ``\\n`` alone."""
        cut = np.flatnonzero(self.data == 10)
        starts = np.union1d(self.offset[:-1], cut + 1)
        starts = starts[starts < len(self.data)]
        ends = np.append(starts[1:], len(self.data))
        ends = ends - (self.data[ends - 1] == 10) if len(ends) else ends
        with_word = np.searchsorted(self.word_start, ends) > np.searchsorted(self.word_start, starts)
        starts, ends = starts[with_word], ends[with_word]
        return starts, ends, np.searchsorted(self.offset, starts, side="right") - 1


def per_part(flags: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """Sum of flags over each [offset[i], offset[i+1])."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[offset[1:]] - sums[offset[:-1]]


def group_sizes(doc: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal (doc, key) pairs: the order that groups them, each group's start, each group's size."""
    order = np.argsort(mix(key ^ (doc.astype(U64) + U64(1)) * GOLDEN), kind="stable")
    d, k = doc[order], key[order]
    first = np.flatnonzero(np.concatenate(([True], (d[1:] != d[:-1]) | (k[1:] != k[:-1])))) if len(order) else np.zeros(0, np.int64)
    return order, first, np.diff(np.append(first, len(order)))


def repeated_lines(t: Texts) -> np.ndarray:
    """Per text, lines holding a word that equal an earlier line of the same text."""
    start, end, doc = t.lines()
    order, first, size = group_sizes(doc, spans_hash(t.data, start, end)) if len(start) else (start, start, start)
    return np.bincount(doc[order[first]], size - 1, t.n).astype(np.int64) if len(start) else np.zeros(t.n, np.int64)


def words_in_repeats(t: Texts, width: int) -> np.ndarray:
    """Per text, words lying in a window of ``width`` words that occurs twice or more in it."""
    key, doc, first_word = t.windows(width)
    if not len(key):
        return np.zeros(t.n, np.int64)
    order, first, size = group_sizes(doc, key)
    again = first_word[order[np.repeat(size > 1, size)]]
    step = np.zeros(len(t.word_start) + 1, np.int64)
    np.add.at(step, again, 1)
    np.add.at(step, again + width, -1)
    return per_part(np.cumsum(step[:-1]) > 0, t.word_offset)


def column_texts(column: pa.Array, slice_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int, Texts]]:
    """(from row, to row, Texts) over a string column, cut between rows into bounded slices.

    A null is an empty text.  A text is never cut: one longer than ``slice_bytes`` makes a
    slice of its own.
    """
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64, count=column.offset + len(column) + 1)[column.offset :] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + slice_bytes, side="right")) - 1)
        hi = min(hi, len(column))
        yield lo, hi, Texts(raw[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])
        lo = hi
