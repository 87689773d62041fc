"""Vectorised word hashing over Arrow string columns.

A word is a maximal run of bytes other than space and 0x09-0x0D.  Every word of a
block of documents gets a 64-bit hash from a handful of numpy passes over the raw
UTF-8 buffer, with no per-word Python objects: each byte contributes
``table[byte] * base**position`` and a word's sum is normalised by the inverse power
of its start, so equal words hash equally wherever they stand.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes handled at a time; one longer document is handled alone.
BLOCK_BYTES = 1 << 17

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> _U(27))
    h = h * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


_EXACT = mix(np.arange(1, 257, dtype=_U) * _U(0xD1B54A32D192ED03))
_FOLDED = _EXACT.copy()
_FOLDED[65:91] = _EXACT[97:123]


class _Powers:
    """base**i and its inverse, grown on demand and kept for the worker's life."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, _U)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << max(12, (n - 1).bit_length())
            with np.errstate(over="ignore"):
                self.up, self.down = np.full(size, _BASE, _U), np.full(size, _INVERSE, _U)
                self.up[0] = self.down[0] = 1
                self.up, self.down = np.cumprod(self.up, dtype=_U), np.cumprod(self.down, dtype=_U)
        return self.up[:n], self.down[:n]


_powers = _Powers()


def column_buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = column.fill_null("") if column.null_count else column
    wide = pa.types.is_large_string(column.type)
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def blocks(raw: np.ndarray, off: np.ndarray, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about `size` bytes together."""
    i, n = 0, len(off) - 1
    while i < n:
        j = int(np.searchsorted(off, off[i] + size, "right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j
        i = j


def span_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray, fold: bool = False) -> np.ndarray:
    """A 64-bit hash of each span of bytes; fold: letters A-Z count as a-z."""
    n = len(raw)
    up, down = _powers.upto(n + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(n + 1, _U)
        np.cumsum((_FOLDED if fold else _EXACT)[raw] * up[:n], out=total[1:])
        return mix((total[end] - total[start]) * down[start] + (end - start).astype(_U))


def words(raw: np.ndarray, off: np.ndarray, fold: bool = False, breaks: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, document, start, end) of each word; document, start and end count from this block's first.

    fold: letters A-Z count as a-z; breaks: the bytes that words are made without.
    """
    base = off[0]
    raw = raw[base : off[-1]]
    off = off - base
    n = len(raw)
    if n == 0:
        e = np.zeros(0, np.int64)
        return np.zeros(0, _U), e, e, e
    solid = ~breaks[raw]
    # A document's first byte starts a word whatever precedes it.
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    before = np.concatenate([[False], solid[:-1]])
    start = np.flatnonzero(solid & (~before | edge[:-1]))
    after = np.concatenate([solid[1:], [False]])
    end = np.flatnonzero(solid & (~after | edge[1:])) + 1
    doc = np.searchsorted(off, start, "right") - 1
    return span_hashes(raw, start, end, fold), doc, start, end


def shingles(h: np.ndarray, doc: np.ndarray, n_docs: int, width: int) -> list[np.ndarray]:
    """Each document's sorted distinct shingle hashes; a shorter one's only shingle is its whole word sequence."""
    counts = np.bincount(doc, minlength=n_docs)
    first = np.concatenate([[0], np.cumsum(counts)])
    step = _U(0xC2B2AE3D27D4EB4F)
    with np.errstate(over="ignore"):
        m = max(0, len(h) - width + 1)
        rolled = np.full(m, width, _U)
        for k in range(width):
            rolled = rolled * step + h[k : k + m]
        rolled = mix(rolled)
        out = []
        for d in range(n_docs):
            a, c = int(first[d]), int(counts[d])
            if c >= width:
                s = np.sort(rolled[a : a + c - width + 1])
                out.append(s if len(s) < 2 else s[np.concatenate([[True], s[1:] != s[:-1]])])
            elif c:
                v = _U(c)
                for x in h[a : a + c]:
                    v = v * step + x
                out.append(mix(np.array([v], _U)))
            else:
                out.append(np.zeros(0, _U))
    return out
