"""Periodic runs of words, found by string synchronising sets at dyadic scales."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import slices, widened, words_of
from .textbytes import mix64

#: Least length of a run, in words and in periods.
LEAST, POWER = 6, 4
#: Smallest scale; periods below it are found by comparing words at that distance.
FIRST_SCALE = 4

_NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)


def doubled(h: np.ndarray, step: int) -> np.ndarray:
    """Names of the fragments of ``2 * step`` words, from those of ``step`` words."""
    if len(h) <= step:
        return h[:0]
    return mix64(h[:-step] * np.uint64(0x9E3779B97F4A7C15) + h[step:] + np.uint64(2 * step))


def window_least(x: np.ndarray, n: int) -> np.ndarray:
    """The least value of each ``n`` consecutive ones, by the least of blocks from their ends."""
    count = len(x) - n + 1
    if count <= 0:
        return x[:0]
    padded = np.full(-(-len(x) // n) * n, _NEVER)
    padded[:len(x)] = x
    blocks = padded.reshape(-1, n)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:count], ahead[n - 1:n - 1 + count])


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` positions lie in any of the half-open spans."""
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, ends, -1)
    return np.cumsum(change[:n]) > 0


def stretches(words: np.ndarray, period: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every longest stretch of at least ``POWER`` periods, by comparing words directly."""
    same = np.zeros(len(words) - period + 2, np.int8)
    same[1:-1] = words[:-period] == words[period:]
    edge = np.diff(same)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + period
    long = end - start >= POWER * period
    return start[long], end[long]


def extended(names: list[np.ndarray], s: np.ndarray, period: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the stretch with ``period`` around each ``s``: jumps by fragments with equal names."""
    last, first = s.copy(), s.copy()
    top = len(names) - 1
    for k in range(top, -1, -1):
        h, step, more = names[k], 1 << k, True
        while more:
            on = np.flatnonzero(last + period + step <= n)
            on = on[h[last[on]] == h[last[on] + period[on]]]
            back = np.flatnonzero(first >= step)
            back = back[h[first[back] - step] == h[first[back] - step + period[back]]]
            last[on] += step
            first[back] -= step
            more = k == top and len(on) + len(back) > 0  # below the top one jump at each step is enough
    return first, last + period


def synchronising(names: np.ndarray, periodic: np.ndarray, scale: int) -> np.ndarray:
    """The synchronising set: positions whose fragment, or the one ``scale`` later, has the least name of the
    ``scale + 1`` fragments from the one to the other, fragments in highly periodic regions left out.

    Membership depends on the ``2 * scale`` words from the position only.
    """
    values = np.where(periodic, _NEVER, names)
    least = window_least(values, scale + 1)
    return np.flatnonzero((least != _NEVER) & ((values[:len(least)] == least) | (values[scale:] == least)))


def proposed(context: np.ndarray, members: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Members and distances to the next one with equal context, for distances from ``scale`` to ``2 * scale - 1``.

    Of members at most a distance apart that propose the same distance, and so lie in one stretch, the first is given.
    """
    order = members[np.argsort(context[members], kind="stable")]
    gap = np.diff(order)
    pair = (context[order[1:]] == context[order[:-1]]) & (gap >= scale) & (gap < 2 * scale)
    s, p = order[:-1][pair], gap[pair]
    key = np.lexsort((s, p))
    s, p = s[key], p[key]
    keep = np.ones(len(s), bool)
    keep[1:] = (p[1:] != p[:-1]) | (s[1:] - s[:-1] > p[1:])
    return s[keep], p[keep]


def runs(words: np.ndarray, longest: int | None = None) -> np.ndarray:
    """Rows ``(start, end, period)`` of all runs of a sequence of word numbers, by start, then period.

    A run is a longest stretch with its smallest period, of at least ``POWER`` periods and ``LEAST`` words. At scale
    ``t`` the synchronising set has a member in each ``t`` positions of a run with period ``p`` from ``t`` to
    ``2 * t - 1``, and the member ``p`` words on is the next with the same ``2 * t`` words; so pairs of next equal
    contexts propose all these periods. Fragments of ``t`` words with a period of at most ``t / 4`` are no members:
    they lie in stretches found at smaller scales, those of the smallest periods by direct comparison. Scales end at
    a quarter of ``longest``, the length of the longest run there can be.
    """
    n, longest = len(words), len(words) if longest is None else longest
    found = np.zeros((0, 3), np.int64)
    if longest < LEAST:
        return found
    for period in range(1, min(FIRST_SCALE, longest // POWER + 1)):
        start, end = stretches(words, period)
        found = np.concatenate([found, np.stack([start, end, np.full(len(start), period)], 1)])
    names = [mix64(words.astype(np.uint64) + np.uint64(1))]
    while 1 << len(names) <= longest:
        names.append(doubled(names[-1], 1 << (len(names) - 1)))
    scale, k = FIRST_SCALE, FIRST_SCALE.bit_length() - 1
    while POWER * scale <= longest:
        regions = found[(POWER * found[:, 2] <= scale) & (found[:, 1] - found[:, 0] >= scale)]
        periodic = covered(regions[:, 0], regions[:, 1] - scale + 1, len(names[k]))
        s, p = proposed(names[k + 1], synchronising(names[k], periodic, scale), scale)
        if len(s):
            start, end = extended(names, s, p, n)
            long = end - start >= POWER * p
            found = np.concatenate([found, np.stack([start, end, p], 1)[long]])
        scale, k = 2 * scale, k + 1
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    first = np.ones(len(found), bool)  # of periods of one stretch the smallest; proposals of one run are equal rows
    first[1:] = (found[1:, :2] != found[:-1, :2]).any(1)
    found = found[first & (found[:, 1] - found[:, 0] >= LEAST)]
    for start, end, p in found[found[:, 2] >= FIRST_SCALE].tolist():  # words decide, not their names
        if not np.array_equal(words[start:end - p], words[start + p:end]):
            raise ValueError("two different fragments have one name")
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def numbered(texts: list[bytes]) -> list[tuple[list[bytes], np.ndarray]]:
    """The words of each text and their numbers; equal words have equal numbers in all of them."""
    numbers: dict[bytes, int] = {}
    split = [t.split() for t in texts]  # at the six white space bytes
    return [(w, np.array([numbers.setdefault(x, len(numbers)) for x in w], np.int64)) for w in split]


def runs_of_all(rows: list[np.ndarray]) -> list[np.ndarray]:
    """``runs`` of many sequences; those of similar length are searched as one, with a mark of its own after each."""
    out = [np.zeros((0, 3), np.int64)] * len(rows)
    classes: dict[int, list[int]] = {}
    for i, row in enumerate(rows):
        if len(row) >= LEAST:
            classes.setdefault(len(row).bit_length() // 2, []).append(i)
    for own in classes.values():
        lengths = np.array([len(rows[i]) + 1 for i in own])
        ends = np.cumsum(lengths)
        words = np.empty(ends[-1], np.int64)
        for i, end in zip(own, ends.tolist()):
            words[end - len(rows[i]) - 1:end - 1] = rows[i]
        words[ends - 1] = -2 - np.arange(len(own))
        found = runs(words, int(lengths.max()) - 1)
        at = np.searchsorted(ends, found[:, 0], side="right")
        for j, first, last in zip(*_groups(at)):
            shift = ends[j] - lengths[j]
            out[own[j]] = found[first:last] - np.array([shift, shift, 0])
    return out


def _groups(at: np.ndarray) -> tuple[list[int], list[int], list[int]]:
    """Values of a sorted array with the first place and the one after the last of each."""
    edge = np.flatnonzero(np.diff(at, prepend=-1))
    return at[edge].tolist(), edge.tolist(), np.append(edge[1:], len(at)).tolist() if len(edge) else []


def with_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with three columns on ``text`` added: ``pr_words``, the number of its words; ``pr_runs``, the start,
    length and period of its runs in words, by start, then period; ``pr_text``, the words that no run covers after
    its first period, joined by one blank.

    Words end at blanks and tabs to carriage returns. A NULL or empty text has no words, no runs and an empty
    ``pr_text``. Columns whose names begin with ``pr_`` are replaced, all others pass through; repeated rows stay; an
    empty table stays empty. Texts are searched whole; a task's memory follows its longest text.
    """
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if not c.startswith("pr_")])
    names = docs.columns
    added = {"pr_words": "long", "pr_runs": "array<struct<start:long,length:long,period:long>>", "pr_text": "string"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "pr_source", 2 << 20)):
            split = numbered([t or b"" for t in batch.column("pr_source").to_pylist()])
            found = runs_of_all([n for _, n in split])
            kept = []
            for (words, _), own in zip(split, found):
                if len(own):
                    gone = covered(own[:, 0] + own[:, 2], own[:, 1], len(words))
                    words = [w for w, g in zip(words, gone.tolist()) if not g]
                kept.append(b" ".join(words))
            rows = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
            fields = [pa.array(rows[:, 0]), pa.array(rows[:, 1] - rows[:, 0]), pa.array(rows[:, 2])]
            places = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array([len(w) for w, _ in split], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(places), pa.StructArray.from_arrays(fields, ["start", "length", "period"])),
                 pa.array(kept, pa.binary()).view(pa.string())], [*names, *added])

    return docs.withColumn("pr_source", F.col(text).cast("binary")).mapInArrow(run, widened(docs, **added))


def planted(key: Column, text: Column) -> Column:
    """The text with a period written over its end, for about a tenth of the keys; a NULL key changes nothing.

    With the CRC-32 ``h`` of the key, ``g = h div 10`` and ``n`` words, the words from number ``a = g % n`` on repeat
    the first ``1 + (n - a) div (3 + g % 8)`` of them.
    """
    h = F.crc32(key.cast("string"))
    g = F.floor(h / 10)

    def bound(value: Column, use) -> Column:  # evaluates value once, not once for each word
        return F.transform(F.array(value), use)[0]

    def cut(words: Column) -> Column:
        n = F.size(words)
        a = g % n
        return F.struct(words.alias("words"), a.alias("a"), (1 + F.floor((n - a) / (3 + g % 8))).alias("period"))

    def source(s: Column, i: Column) -> Column:
        return F.when(i < s.a, i).otherwise(s.a + (i - s.a) % s.period).cast("int")

    def written_over(s: Column) -> Column:
        return F.array_join(F.transform(F.sequence(F.lit(0), F.size(s.words) - 1), lambda i: F.get(s.words, source(s, i))), " ")

    made = bound(words_of(text), lambda words: F.when(F.size(words) > 0, bound(cut(words), written_over)))
    return F.when(h % 10 == 0, F.coalesce(made, text)).otherwise(text)


def digest(docs: DataFrame) -> DataFrame:
    """The longest run and the digests of all runs and of the collapsed text, for every document after planting."""
    rows = with_runs(docs.select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text")))
    best = F.array_max(F.transform("pr_runs", lambda r: F.struct(
        r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    lines = F.transform("pr_runs", lambda r: F.concat(F.concat_ws(",", *(r[k].cast("string") for k in ("start", "length", "period"))), F.lit("\n")))
    return rows.withColumn("best", best).select(
        "doc_id", F.size("pr_runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("pr_text", 256).alias("collapsed_sha256"))
