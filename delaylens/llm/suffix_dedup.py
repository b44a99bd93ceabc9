"""Removal of byte strings that occur more than once, by a distributed merge sort of suffixes.

Sorting every suffix of a corpus costs too much, so only suffixes at anchors are sorted: the anchor of a window of
``length`` bytes is the place of its smallest k-gram hash, which depends on the window's content alone. Equal windows
therefore have their anchors at equal distances, and it suffices to compare the suffixes at anchors together with
the bytes before them.

Each task sorts its suffixes into a run and front-codes it: a suffix is stored as the length it shares with the one
before it and the rest. Runs are exchanged by range and merged with loser trees that know how much a string shares
with the last one put out, and compare only what lies beyond.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from . import bloom
from .common import slices, small_batches, widened, written
from .textbytes import chunks, mix64, powers

LENGTH, GRAM = 400, 32
#: Bytes of a long text worked on at once, of suffixes sorted in one run, of text per range of the merge, and ranges
#: per task. The part of a run in one range is a row, so that rows stay small.
PIECE, RUN_BYTES, RANGE_BYTES, RANGES_PER_TASK = 1 << 22, 6 << 20, 4 << 20, 4
#: Distinct spans of a group up to which pairs are compared; larger groups are swept by distance.
PAIRWISE = 48
#: Front-coded bytes that the merge takes in one range, or this many times the mean if that is more; the windows of a
#: larger range are counted by Spark.
HOT_BYTES, HOT_TIMES = 16 << 20, 4

_SPREAD = mix64(np.arange(1, 257, dtype=np.uint64))
_AT = np.uint64((1 << 24) - 1)
_ENTRY = struct.Struct("<HHHB16sQ")


# --- anchors ---------------------------------------------------------------------------------------

def anchors(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """``(anchor, first window, last window, hash)``: runs of windows with one anchor, text by text.

    Runs are cut at fixed distances from the anchor. The hash is of the bytes that all windows of such a cell hold,
    more than three quarters of a window, so that a short passage which many texts share brings no group together.
    """
    none = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    n, m = len(data), len(data) - GRAM + 1
    if n < length:
        return none
    padded = np.zeros(n + 8, np.uint8)
    padded[:n] = data
    eight = np.ndarray((n,), "<u8", padded, 0, (1,))
    h = eight[:m] * np.uint64(0x9E3779B97F4A7C15)
    for k, c in ((8, 0xC2B2AE3D27D4EB4F), (16, 0x165667B19E3779F9), (24, 0xD6E8FEB86659FD93)):
        h += eight[k:m + k] * np.uint64(c)
    h = mix64(h)
    least = (h & ~_AT) | np.arange(m, dtype=np.uint64)
    width, size = length - GRAM + 1, 1
    while 2 * size <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < width:
        least = np.minimum(least[:len(least) - (width - size)], least[width - size:])
    inside = np.zeros(n + 1, np.int32)
    long = np.diff(offsets) >= length
    np.add.at(inside, offsets[:-1][long], 1)
    np.add.at(inside, offsets[1:][long] - length + 1, -1)
    at = np.flatnonzero(np.cumsum(inside)[:len(least)])
    if not len(at):
        return none
    found = (least[at] & _AT).astype(np.int64)
    new = np.flatnonzero(np.append(True, found[1:] != found[:-1]))
    last = np.append(new[1:], len(found)) - 1
    anchor, first, last = found[new], at[new], at[last]
    cell = max(1, (length - GRAM) // 4)
    low = (anchor - last) // cell
    many = (anchor - first) // cell - low + 1
    which = np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    anchor, first, last = (np.repeat(x, many) for x in (anchor, first, last))
    first, last = np.maximum(first, anchor - which * cell - cell + 1), np.minimum(last, anchor - which * cell)
    up, down = powers(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((_SPREAD[data]) * up[:n], out=sums[1:])
    start = anchor - which * cell
    held = (sums[start + length - cell + 1] - sums[start]) * down[start]
    return anchor, first, last, mix64(held + which.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def pieces(column: pa.Array, length: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first text, place in it, bytes, offsets)``; parts of long texts overlap by a window less one byte."""
    for lo, hi, data, offsets in chunks(column):
        if len(data) <= PIECE + length:
            yield lo, 0, data, offsets
            continue
        for start in range(0, len(data) - length + 1, PIECE):  # a single long text
            part = data[start:start + PIECE + length - 1]
            yield lo, start, part, np.array([0, len(part)])


# --- runs ------------------------------------------------------------------------------------------

def shared(a: bytes, b: bytes, known: int = 0) -> int:
    """The length of the common prefix, of which ``known`` bytes are known to be equal."""
    n = min(len(a), len(b))
    if a[known:n] == b[known:n]:
        return n
    step = 16
    while a[known:known + step] == b[known:known + step]:
        known += step
        step *= 2
    while step > 1:
        step //= 2
        if a[known:known + step] == b[known:known + step]:
            known += step
    return known


def encode(run: list[tuple]) -> bytes:
    """Front-code sorted ``(key, left, many, text, anchor)``; ``left`` are the bytes before the anchor, backwards."""
    out, before = [], b""
    for key, left, many, text, at in run:
        same = shared(before, key)
        out.append(_ENTRY.pack(same, len(key) - same, len(left), many, text, at))
        out.append(key[same:])
        out.append(left)
        before = key
    return b"".join(out)


def decode(blob: bytes) -> Iterator[tuple]:
    """``(shared with the entry before, key, left, many, text, anchor)`` of a run."""
    at, key = 0, b""
    while at < len(blob):
        same, more, n_left, many, text, place = _ENTRY.unpack_from(blob, at)
        at += _ENTRY.size
        key = key[:same] + blob[at:at + more]
        at += more
        yield same, key, blob[at:at + n_left], many, text, place
        at += n_left


class LoserTree:
    """Merge of sorted runs. Each run's head carries the length it shares with the last string put out.

    Of two heads the one that shares more comes first, and the other's length stays valid. Only at equal lengths are
    bytes compared, from that length on; what they share is then the loser's length. So no byte that is known to be
    equal is looked at again.
    """

    def __init__(self, runs: list[Iterator[tuple]]):
        self.runs = runs
        self.size = 1
        while self.size < len(runs):
            self.size *= 2
        self.heads: list = [next(r, None) for r in runs] + [None] * (self.size - len(runs))
        self.known = [0] * self.size
        self.losers = [0] * self.size
        winners = [0] * self.size + list(range(self.size))
        for node in range(self.size - 1, 0, -1):
            winners[node], self.losers[node] = self._play(winners[2 * node], winners[2 * node + 1])
        self.winner = winners[1]

    def _play(self, a: int, b: int) -> tuple[int, int]:
        x, y = self.heads[a], self.heads[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        if self.known[a] != self.known[b]:
            return (a, b) if self.known[a] > self.known[b] else (b, a)
        same = shared(x[1], y[1], self.known[a])
        first, second = (a, b) if x[1][same:same + 1] <= y[1][same:same + 1] else (b, a)
        self.known[second] = same
        return first, second

    def __iter__(self) -> Iterator[tuple]:
        """Entries in order, their first field the length shared with the entry before."""
        while (head := self.heads[w := self.winner]) is not None:
            yield (self.known[w], *head[1:])
            self.heads[w] = new = next(self.runs[w], None)
            self.known[w] = new[0] if new else 0
            node = (w + self.size) // 2
            while node:
                w, self.losers[node] = self._play(w, self.losers[node])
                node //= 2
            self.winner = w


# --- what is covered -------------------------------------------------------------------------------

def _ranked(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, int]:
    """Places in sorted order, what neighbours share, and the most that any two share."""
    order = sorted(set(strings))
    lcp = np.array([0] + [shared(a, b) for a, b in zip(order, order[1:])])
    place = {s: i for i, s in enumerate(order)}
    ranks = np.array([place[s] for s in strings])
    twice = np.flatnonzero(np.bincount(ranks) > 1)
    return ranks, lcp, max([int(lcp.max()), *(len(order[i]) for i in twice)])


def _sweep(spans: list[tuple[bytes, bytes]], length: int) -> list[list[tuple[int, int]]]:
    """Per span the ranges of distances whose window another span has too; work in proportion to the spans.

    For each distance the sorted suffixes fall into classes that share enough after the anchor, the sorted left sides
    into classes that share enough before it.
    """

    right, right_lcp, most_right = _ranked([r for r, _ in spans])
    left, left_lcp, most_left = _ranked([b for _, b in spans])
    if most_right - 8 + most_left < length:
        return [[] for _ in spans]
    low = np.array([length + 8 - len(r) for r, _ in spans])
    high = np.array([len(b) for _, b in spans])
    covered = np.zeros((len(spans), high.max() + 3), bool)
    for d in range(max(low.min(), length + 8 - most_right), min(high.max(), most_left) + 1):
        own = np.flatnonzero((low <= d) & (d <= high))
        if len(own) < 2:
            continue
        a, b = np.cumsum(right_lcp < length + 8 - d), np.cumsum(left_lcp < d)
        _, inverse, times = np.unique(a[right[own]] * (len(left_lcp) + 1) + b[left[own]], return_inverse=True, return_counts=True)
        covered[own, d + 1] = times[inverse] > 1
    out = []
    for row in covered:
        edge = np.flatnonzero(row[1:] != row[:-1])
        out.append([(int(lo), int(hi) - 1) for lo, hi in zip(edge[::2], edge[1::2])])
    return out


def resolve(group: list[tuple], length: int) -> Iterator[tuple[bytes, int, int]]:
    """``(text, start, stop)`` covered in a group of entries with one hash and k-gram at their anchors.

    A span is what follows an anchor (behind the 8 hash bytes of its key) and what precedes it. Equal spans cover all
    their windows; different ones those windows that both contain.
    """
    spans: dict[tuple[bytes, bytes], list] = {}
    for _, key, left, many, text, at in group:
        spans.setdefault((key, left), []).append((many, text, at))
    distinct = list(spans)
    found: list[list[tuple[int, int]]] = [[] for _ in distinct]
    if 1 < len(distinct) <= PAIRWISE:
        for i, (key, left) in enumerate(distinct):
            for j in range(i):
                low = max(length + 8 - shared(key, distinct[j][0], 8), length + 8 - min(len(key), len(distinct[j][0])))
                high = shared(left, distinct[j][1])
                if low <= high:
                    found[i].append((low, high))
                    found[j].append((low, high))
    elif len(distinct) > 1:
        found = _sweep(distinct, length)
    for (key, left), ranges in zip(distinct, found):
        entries = spans[key, left]
        if len(entries) > 1 or entries[0][0]:
            ranges = [(length + 8 - len(key), len(left))]
        for low, high in ranges:
            for _, text, at in entries:
                yield text, at - high, at - low + length


# --- tables ----------------------------------------------------------------------------------------

FOUND = "range int, run binary, text binary, start long, stop long"
_FOUND = pa.schema([("range", pa.int32()), ("run", pa.binary()), ("text", pa.binary()), ("start", pa.int64()), ("stop", pa.int64())])


def _batch(runs: list[tuple[int, bytes]], covered: set[tuple[bytes, int, int]]) -> pa.RecordBatch:
    joined: list[list] = []
    for t, a, z in sorted(covered):
        if joined and joined[-1][0] == t and a <= joined[-1][2]:
            joined[-1][2] = max(z, joined[-1][2])
        else:
            joined.append([t, a, z])
    rows = [(r, b, None, None, None) for r, b in runs] + [(t[0] - 65536, None, t, a, z) for t, a, z in joined]
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), _FOUND)], schema=_FOUND)


def sorted_runs(docs: DataFrame, length: int, twice: Broadcast, ranges: int) -> DataFrame:
    """Front-coded runs by range, and what is found covered within a run.

    Of equal spans in a run only one goes on, marked as many, so a passage with any number of copies is exchanged
    once per run.
    """

    def flush(entries: list[tuple]) -> Iterator[pa.RecordBatch]:
        entries.sort(key=lambda e: e[:2])
        covered, runs, run, at = set(), [], [], 0
        current = None
        while at < len(entries):
            key, left = entries[at][:2]
            end = at + 1
            while end < len(entries) and entries[end][:2] == (key, left):
                end += 1
            if end - at > 1:
                covered |= {(t, a - len(left), a + len(key) - 8) for _, _, t, a in entries[at:end]}
            which = int.from_bytes(key[:4], "big") * ranges >> 32
            if which != current and run:
                runs.append((current, encode(run)))
                run = []
            current = which
            run.append((key, left, end - at > 1, *entries[at][2:]))
            at = end
        if run:
            runs.append((current, encode(run)))
        for first in range(0, len(runs), 32):
            yield _batch(runs[first:first + 32], covered if not first else set())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries, size = [], 0
        for batch in batches:
            for lo, base, data, offsets in pieces(batch.column("sx_text"), length):
                at, first, last, h = anchors(data, offsets, length)
                hit = twice.value.hits(h)
                at, first, last, h = at[hit], first[hit], last[hit], h[hit]
                if not len(at):
                    continue
                raw, doc = data.tobytes(), np.searchsorted(offsets, at, side="right") - 1
                ids: dict[int, bytes] = {}
                for i, a, z, g, d in zip(at.tolist(), first.tolist(), last.tolist(), h.tolist(), doc.tolist()):
                    if d not in ids:
                        ids[d] = batch.column("sx_id")[lo + d].as_py()
                    entries.append((g.to_bytes(8, "big") + raw[i:z + length], raw[a:i][::-1], ids[d],
                                    base + i - int(offsets[d])))
                    size += z - a + length + 200
                if size > RUN_BYTES:
                    yield from flush(entries)
                    entries, size = [], 0
        yield from flush(entries)

    return docs.mapInArrow(work, FOUND)


def covered_parts(runs: DataFrame, length: int, ranges: int) -> DataFrame:
    """``(text, start, stop)`` from the merge of all runs, range by range."""

    def merge(blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        group, out = [], set()
        for entry in LoserTree([decode(b) for b in blobs]):
            if entry[0] < 8 + GRAM:
                if len(group) > 1 or group and group[0][3]:
                    out.update(resolve(group, length))
                group = []
                if len(out) > 50_000:
                    yield _batch([], out)
                    out = set()
            group.append(entry)
        if len(group) > 1 or group and group[0][3]:
            out.update(resolve(group, length))
        if out:
            yield _batch([], out)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, current = [], None
        for batch in batches:
            is_run = pc.is_valid(batch.column("run"))
            rest = batch.filter(pc.invert(is_run))
            if rest.num_rows:
                yield rest
            own = batch.filter(is_run)
            for which, run in zip(own.column("range").to_pylist(), own.column("run")):
                blob = run.as_py()
                if which != current:
                    yield from merge(held)
                    held, current = [], which
                held.append(blob)
        yield from merge(held)

    dealt = runs.repartition(max(12, ranges // RANGES_PER_TASK), "range").sortWithinPartitions("range")
    return dealt.mapInArrow(work, FOUND).select("text", "start", "stop").distinct()


def hot_ranges(runs: DataFrame, ranges: int) -> list[int]:
    """Ranges with more than the merge should take in one task: passages that very many texts hold."""
    sizes = runs.where(F.col("run").isNotNull()).groupBy("range").agg(F.sum(F.octet_length("run")).alias("n")).collect()
    most = max(HOT_BYTES, HOT_TIMES * sum(r["n"] for r in sizes) / ranges)
    return [r["range"] for r in sizes if r["n"] > most]


def counted_parts(runs: DataFrame, length: int) -> DataFrame:
    """``(text, start, stop)`` from runs of any size, by counts of equal windows; no task holds a group.

    A span has at most a quarter of ``length`` windows, which go by 128-bit hashes.
    """

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in batch.column("run"):
                rows = []
                for _, key, left, many, text, at in decode(run.as_py()):
                    whole = left[::-1] + key[8:]
                    for i in range(len(whole) - length + 1):
                        h = hashlib.blake2b(whole[i:i + length], digest_size=16).digest()
                        rows.append((h, bool(many), text, at - len(left) + i))
                    if len(rows) > 20_000:
                        yield named(rows)
                        rows = []
                if rows:
                    yield named(rows)

    def named(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.binary(), pa.bool_(), pa.binary(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], ["win", "many", "text", "start"])

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, block, bits in zip(*(batch.column(c).to_pylist() for c in ("text", "block", "bits"))):
                own = np.unpackbits(np.array([bits], np.int64).view(np.uint8), bitorder="little")
                edge = np.flatnonzero(np.diff(np.concatenate([[0], own, [0]]).astype(np.int8)))
                rows += [(text, 64 * block + lo, 64 * block + hi - 1 + length)
                         for lo, hi in zip(edge[::2].tolist(), edge[1::2].tolist())]
            if rows:
                kinds = (pa.binary(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], ["text", "start", "stop"])

    found = written(runs.mapInArrow(windows, "win binary, many boolean, text binary, start long"), "windows")
    twice = found.groupBy("win").agg(F.count("*").alias("n"), F.max("many").alias("again")).where("n > 1 OR again")
    marks = found.join(twice.select("win"), "win").groupBy("text", F.expr("start div 64").alias("block")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(start % 64 AS INT)))").alias("bits"))
    return marks.mapInArrow(ranges, "text binary, start long, stop long")


def without_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` with ``sx_bytes``, ``sx_removed``, ``sx_spans`` and ``sx_kept`` (binary) added.

    Removed is each byte of a UTF-8 text inside a string of ``length`` bytes that also starts elsewhere, in the same
    or another row; matches overlap but don't cross rows, and are judged on the input. A NULL text is empty. Repeated
    rows remove each other, texts shorter than ``length`` lose nothing. ``sx_kept`` is binary, since a cut may fall
    inside a character. Extra columns pass through, except that those whose names begin with ``sx_`` are replaced.
    """
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if not c.startswith("sx_")])
    slim = docs.select(F.col(text).alias("sx_text"), F.unhex(F.md5(F.col(text))).alias("sx_id"))
    n = slim.agg(F.sum(F.octet_length("sx_text")).alias("n")).first()["n"] or 0

    def hashes(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for _, _, data, offsets in pieces(batch.column("sx_text"), length):
            yield anchors(data, offsets, length)[3]

    with small_batches(docs.sparkSession):
        twice = bloom.build(slim.select("sx_text"), hashes, 6 * n // (length - GRAM) + 1)
        ranges = int(min(20_000, max(12, n // RANGE_BYTES)))
        runs = sorted_runs(slim, length, twice, ranges)
        hot = hot_ranges(runs, ranges)
        if hot:
            is_hot = F.coalesce(F.col("range").isin(hot), F.lit(False))
            parts = covered_parts(runs.where(~is_hot), length, ranges)
            parts = parts.union(counted_parts(runs.where(is_hot), length)).distinct()
        else:
            parts = covered_parts(runs, length, ranges)
        parts = parts.groupBy("text").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("sx_parts"))
        parts = written(parts.withColumnRenamed("text", "sx_covered"), "covered")
    rows = docs.withColumn("sx_id", F.unhex(F.md5(F.col(text)))).join(
        parts, F.col("sx_id") == F.col("sx_covered"), "left")
    rows = rows.select(*[F.col(f"`{c}`") for c in docs.columns], F.col(text).cast("binary").alias("sx_text"), "sx_parts")
    names = docs.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "sx_text")):
            sizes, removed, spans, kept = [], [], [], []
            for raw, own in zip(batch.column("sx_text").to_pylist(), batch.column("sx_parts").to_pylist()):
                raw, out, at, gone, runs = raw or b"", [], 0, 0, 0
                for part in own or ():
                    start, stop = part["start"], part["stop"]
                    if stop <= at:
                        continue
                    if start > at or not runs:
                        out.append(raw[at:start])
                        runs += 1
                        gone += stop - start
                    else:
                        gone += stop - at
                    at = stop
                out.append(raw[at:])
                sizes.append(len(raw))
                removed.append(gone)
                spans.append(runs)
                kept.append(b"".join(out))
            more = [pa.array(x, pa.int64()) for x in (sizes, removed, spans)] + [pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], *more],
                                             [*names, "sx_bytes", "sx_removed", "sx_spans", "sx_kept"])

    return rows.mapInArrow(cut, widened(docs, sx_bytes="long", sx_removed="long", sx_spans="long", sx_kept="binary"))


def digest(docs: DataFrame) -> DataFrame:
    rows = without_repeats(docs.select("doc_id", "text"))
    return rows.select("doc_id", F.col("sx_bytes").alias("n_bytes"), F.col("sx_removed").alias("n_removed"),
                       F.col("sx_spans").alias("n_spans"), F.sha2("sx_kept", 256).alias("kept_sha256"))
