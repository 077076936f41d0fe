"""Vectorised word helpers for Arrow batches of texts.

A word is a maximal run of bytes outside space and 0x09-0x0D, that is
``[^\\x20\\x09-\\x0D]+`` on the UTF-8 form of the text.  All functions work on
slices of a few MB, so their memory does not grow with the batch; one very
long text is cut at white space into several pieces and joined again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
PIECE_BYTES = 4 << 20
U64 = np.uint64

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_powers = np.ones(1, U64)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser (splitmix64) of each element."""
    with np.errstate(over="ignore"):
        z = x + U64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
        z = (z ^ (z >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> U64(27))) * U64(0x94D049BB133111EB)
        return z ^ (z >> U64(31))


def powers(n: int) -> np.ndarray:
    """The first n powers of the hash base, kept from call to call."""
    global _powers
    if len(_powers) < n:
        size = max(n, 1024)
        with np.errstate(over="ignore"):
            out = np.full(size, U64(_BASE))
            out[0] = 1
            _powers = np.cumprod(out, dtype=U64)
    return _powers[:n]


def texts_of(column) -> pa.Array:
    """One large-string array without nulls (a null text is empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    return column


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets (n + 1) and bytes of a large-string array."""
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64, len(column) + 1 + column.offset)[column.offset :]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], data[offsets[0] : offsets[-1]]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of a batch with about ``limit`` bytes of text each."""
    if not batch.num_rows:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(lengths) - lengths) // limit
    cuts = np.flatnonzero(np.diff(part)) + 1
    for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
        yield batch.slice(int(lo), int(hi - lo))


class Words:
    """The words of some texts, one element a word, in text order.

    ``doc``    index of the text in the slice
    ``start``  byte position in the slice's bytes
    ``end``    byte position behind the word
    ``hash``   64-bit hash of the word's bytes
    """

    def __init__(self, column: pa.Array, lower: bool = False, hashes: bool = True):
        offsets, data = raw(column)
        self.offsets, self.data, self.n_docs = offsets, data, len(column)
        if lower:
            data = _LOWER[data]
        starts, ends, found = [], [], []
        lo = 0
        while lo < len(data):
            hi = self._cut(data, lo)
            s, e = self._spans(data[lo:hi], offsets, lo)
            if hashes:
                found.append(self._hash(data[lo:hi], s, e))
            starts.append(s + lo)
            ends.append(e + lo)
            lo = hi
        join = lambda xs, kind: np.concatenate(xs) if xs else np.zeros(0, kind)
        self.start, self.end = join(starts, np.int64), join(ends, np.int64)
        self.hash = join(found, U64) if hashes else None
        self.doc = np.searchsorted(offsets, self.start, side="right") - 1
        self.counts = np.bincount(self.doc, minlength=self.n_docs).astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.counts)])

    @staticmethod
    def _cut(data: np.ndarray, lo: int) -> int:
        """The end of the piece from lo on: the first white space behind PIECE_BYTES."""
        hi = lo + PIECE_BYTES
        while hi < len(data):
            white = np.flatnonzero(_WHITE[data[hi : hi + PIECE_BYTES]])
            if len(white):
                return hi + int(white[0])
            hi += PIECE_BYTES
        return len(data)

    @staticmethod
    def _spans(data, offsets, lo):
        solid = ~_WHITE[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[0] = edge[-1] = True
        inside = offsets[(offsets >= lo) & (offsets <= lo + len(data))] - lo
        edge[inside] = True
        begins, stops = solid.copy(), solid.copy()
        begins[1:] &= ~solid[:-1] | edge[1:-1]
        stops[:-1] &= ~solid[1:] | edge[1:-1]
        return np.flatnonzero(begins), np.flatnonzero(stops) + 1

    @staticmethod
    def _hash(data, s, e):
        if not len(s):
            return np.zeros(0, U64)
        lengths = e - s
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1]) - np.repeat(ends - lengths, lengths)
        chars = data[np.repeat(s, lengths) + at].astype(U64)
        with np.errstate(over="ignore"):
            sums = np.add.reduceat((chars + U64(1)) * powers(int(lengths.max()))[at], ends - lengths)
        return mix(sums)

    def windows(self, width: int) -> np.ndarray:
        """Positions of the first words of all ``width``-word windows inside one text."""
        n = len(self.doc)
        if n < width:
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.doc[: n - width + 1] == self.doc[width - 1 :])

    def window_hash(self, at: np.ndarray, width: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            out = np.full(len(at), U64(width))
            for j in range(width):
                out = mix(out * U64(0xD6E8FEB86659FD93) + self.hash[at + j], 1)
        return out
