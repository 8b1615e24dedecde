"""Whole texts as flat byte arrays inside Arrow tasks: chunking, words and word hashes.

A word is a maximal run of bytes other than space and 0x09-0x0D, with A-Z
lower-cased, so no character set table is involved.  Everything works on the
concatenated bytes of some documents; a chunk holds whole documents and about
``CHUNK`` bytes, one document at least, which bounds the memory of a task by
the longest text and not by the table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 21

_ODD = np.uint64(0x9E3779B97F4A7C15)
_ROUND = tuple(np.uint64(x) for x in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53))
_BASE = 0x5851F42D4C957F2D
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit."""
    x = x ^ (x >> np.uint64(33))
    x *= _ROUND[0]
    x ^= x >> np.uint64(33)
    x *= _ROUND[1]
    x ^= x >> np.uint64(33)
    return x


_BYTE = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _ODD)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and document offsets of a text column; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batch: pa.RecordBatch, column: str, size: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``size`` bytes of text, one row at least."""
    if not batch.num_rows:
        return
    _, offsets = flat(batch.column(column))
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[start] + size, side="right")) - 1
        end = min(batch.num_rows, max(start + 1, end))
        yield batch.slice(start, end - start)
        start = end


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
        np.multiply.accumulate(out, out=out)
    return out


_UP, _DOWN = powers(_BASE, 1 << 16), powers(_BASE_INVERSE, 1 << 16)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, kept between chunks."""
    global _UP, _DOWN
    if n > len(_UP):
        size = 1 << (n - 1).bit_length()
        up, down = powers(_BASE, size), powers(_BASE_INVERSE, size)
        if size > 2 * CHUNK:
            return up, down
        _UP, _DOWN = up, down
    return _UP, _DOWN


class Words:
    """Words of some documents: byte bounds, document and 64-bit hash of each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        space = _SPACE[data]
        inner = ~space
        first = inner.copy()
        first[1:] &= space[:-1]
        edges = offsets[1:-1]
        edges = edges[edges < len(data)]
        first[edges] |= inner[edges]
        self.start = np.flatnonzero(first)
        last = inner.copy()
        last[:-1] &= space[1:] | first[1:]
        self.end = np.flatnonzero(last) + 1
        # number of words before each document's end
        self.bounds = np.searchsorted(self.start, offsets)
        self.per_doc = np.diff(self.bounds)

    def hashes(self) -> np.ndarray:
        """Polynomial hash of each lower-cased word, from prefix sums modulo 2^64, mixed."""
        if not len(self.start):
            return np.empty(0, np.uint64)
        up, down = _tables(len(self.data) + 1)
        sums = np.empty(len(self.data) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(_BYTE[_LOWER[self.data]] * up[: len(self.data)], out=sums[1:])
        own = (sums[self.end] - sums[self.start]) * down[self.start]
        return mix(own ^ ((self.end - self.start).astype(np.uint64) * _ODD))


def shingle_sets(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each document, end to end, and their offsets.

    A shingle is k consecutive words; a document of fewer words has one, made
    of all of them; a document without words has none.
    """
    w, n = words.hashes(), words.per_doc
    weights = mix(np.arange(1, k + 1, dtype=np.uint64) * _ODD) | np.uint64(1)
    if len(w) >= k:
        joined = w[: len(w) - k + 1] * weights[0]
        for j in range(1, k):
            joined += w[j : len(w) - k + 1 + j] * weights[j]
        joined = mix(joined)
    else:
        joined = np.empty(0, np.uint64)
    parts, sizes = [], np.zeros(len(n), np.int64)
    for d, (start, count) in enumerate(zip(words.bounds[:-1].tolist(), n.tolist())):
        if count >= k:
            part = joined[start : start + count - k + 1].copy()
            part.sort()
            keep = np.empty(len(part), bool)
            keep[0] = True
            np.not_equal(part[1:], part[:-1], out=keep[1:])
            part = part[keep]
        elif count:
            short = (w[start : start + count] * weights[:count]).sum(dtype=np.uint64)
            part = mix(np.array([short + np.uint64(count)], np.uint64))
        else:
            continue
        parts.append(part)
        sizes[d] = len(part)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    return (np.concatenate(parts) if parts else np.empty(0, np.uint64)), offsets
