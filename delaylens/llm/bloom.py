"""Bloom filters for hashes seen once and twice, built in tasks and merged by blocks of bits."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

from .common import released, written
from .textbytes import mix64

#: Bits per expected hash, and the most bits of a filter (32 MB). A corpus beyond that fills the filter and more
#: hashes pass; as what passes is confirmed exactly, results stay the same.
BITS_PER_HASH, MOST_BITS, BLOCK_BITS = 16, 1 << 28, 1 << 16
#: Hashes a task gathers before it sends their bits on.
FLUSH = 1 << 19


def positions(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(bits - 1)
    return h & mask, mix64(h + np.uint64(1)) & mask


class Filter:
    """Bits by which most hashes are ruled out; a hash that was in never is."""

    def __init__(self, bits: int, data: np.ndarray):
        self.bits, self.data = bits, data

    def hits(self, h: np.ndarray) -> np.ndarray:
        found = np.ones(len(h), bool)
        for p in positions(h, self.bits):
            found &= (self.data[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1
        return found


def _spread(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct positions of some hashes, and those that two or more hashes set."""
    p, q = positions(h, bits)
    pos, times = np.unique(np.concatenate([p, q[q != p]]), return_counts=True)
    return pos, pos[times > 1]


def _rows(h: list[np.ndarray], bits: int) -> pa.RecordBatch:
    once, twice = _spread(np.concatenate(h), bits)
    block = np.unique(once // np.uint64(BLOCK_BITS))
    size = np.uint64(BLOCK_BITS)
    cut = [(np.searchsorted(a, block * size), np.searchsorted(a, (block + np.uint64(1)) * size)) for a in (once, twice)]
    inside = [(a % np.uint64(BLOCK_BITS)).astype(np.uint16) for a in (once, twice)]
    packed = [[a[lo:hi].tobytes() for lo, hi in zip(*c)] for a, c in zip(inside, cut)]
    return pa.RecordBatch.from_arrays(
        [pa.array(block.astype(np.int32)), pa.array(packed[0], pa.binary()), pa.array(packed[1], pa.binary())],
        ["block", "once", "twice"])


def build(rows: DataFrame, hashes: Callable[[pa.RecordBatch], Iterator[np.ndarray]], expected: int,
          at_least: int = 2, most_bits: int = MOST_BITS, stored: bool = False) -> Broadcast:
    """The filter of the hashes that occur ``at_least`` once or twice, sent to the executors.

    A task sets the bits of its own rows in two filters, once and twice. Merging two tasks' filters, a bit is set
    twice if it is in either or is set once in both. Only positions of set bits are exchanged. With ``stored`` the bits
    are written out and read from there, so that no shuffle is needed once they are made.
    """
    bits = BLOCK_BITS
    while bits < min(most_bits, BITS_PER_HASH * expected):
        bits *= 2

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for h in hashes(batch):
                held.append(h)
                n += len(h)
                if n >= FLUSH:
                    yield _rows(held, bits)
                    held, n = [], 0
        if n:
            yield _rows(held, bits)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, once, twice in zip(*(c.to_pylist() for c in batch.columns)):
                times = seen.setdefault(block, np.zeros(BLOCK_BITS, np.uint8))
                one, two = np.frombuffer(once, np.uint16), np.frombuffer(twice, np.uint16)
                times[one] = np.minimum(times[one] + 1, 2)
                times[two] = 2
        out = [(k, np.packbits(v >= at_least, bitorder="little").tobytes()) for k, v in sorted(seen.items())
               if (v >= at_least).any()]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.int32()), pa.array([v for _, v in out])],
                                             ["block", "bits"])

    spark = rows.sparkSession
    parts = max(1, min(64, bits // BLOCK_BITS // 16))
    found = rows.mapInArrow(local, "block int, once binary, twice binary").repartition(parts, "block").mapInArrow(
        merged, "block int, bits binary")
    if stored:
        found = written(found, "filter")
    data = np.zeros(bits // 8, np.uint8)
    for r in found.toLocalIterator():  # at most MOST_BITS in all
        data[r["block"] * BLOCK_BITS // 8:(r["block"] + 1) * BLOCK_BITS // 8] = np.frombuffer(r["bits"], np.uint8)
    if stored:
        released(found)
    return spark.sparkContext.broadcast(Filter(bits, data))
