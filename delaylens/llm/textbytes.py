"""Words and their hashes for many texts at once, on the bytes of Arrow string columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on at once; a longer text is a chunk of its own.
CHUNK = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTES = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64."""
    if len(_powers[0]) <= n:
        m = max(n + 1, CHUNK + 1)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            p = np.full(m, base, np.uint64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0], _powers[1]


def chunks(column: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first, last, bytes, offsets)`` of runs of texts; NULL is empty. ``offsets`` start at 0."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    if not len(column):
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
        last = min(last, len(column))
        yield first, last, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every word."""
    n = len(data)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    space = _SPACE[data]
    start, end = ~space, ~space
    start[1:] &= space[:-1] | edge[1:n]
    end[:-1] &= space[1:] | edge[1:n]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    return s, e, np.searchsorted(offsets, s, side="right") - 1


def word_hashes(data: np.ndarray, s: np.ndarray, e: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of each word; with ``lower``, A-Z count as a-z."""
    up, down = powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[_LOWER[data] if lower else data] * up[:len(data)], out=sums[1:])
    return mix64((sums[e] - sums[s]) * down[s])


def ngram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of ``n`` consecutive hashes, in order; runs across texts are the caller's to leave out."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(h) - n + 1, np.uint64)
    for k in range(n):
        total += h[k:len(h) - n + 1 + k] * np.uint64(pow(_BASE, 2 * k + 1, 1 << 64))
    return mix64(total)
