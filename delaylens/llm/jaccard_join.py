"""N-gram Jaccard join by signature trees.

Sets that can link share one of their rarest members (a prefix of each set in a common order), so sets meet in blocks
by prefix member. In a block a tree of OR-combined bitmaps and size ranges is traversed against itself; a pair of
nodes is given up once the largest possible overlap is too small. What is left is compared exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from . import bloom
from .common import BROADCAST_BYTES, released, short_lived_shuffles, small_batches, widened, written
from .components import components
from .textbytes import chunks, mix64, ngram_hashes, word_hashes, words

N_WORDS, PERCENT = 5, 80
#: Counters by which members are ordered from rare to frequent; sets in a part of a block; largest bitmap; fan of trees.
COUNTERS, COUNTER_BLOCK = 1 << 18, 1 << 12
BLOCK_SETS = 1024
MOST_BITS, FAN = 1 << 13, 8


# --- sets ------------------------------------------------------------------------------------------

def shingle_sets(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    """For each text the sorted hashes of its distinct n-word shingles, A-Z lower-cased.

    A text with fewer words has one shingle, the whole sequence; one without words has none. Shingles are told apart
    by 64-bit hashes.
    """
    for lo, hi, data, offsets in chunks(column):
        s, e, doc = words(data, offsets)
        h = word_hashes(data, s, e)
        starts = np.searchsorted(doc, np.arange(hi - lo + 1))
        grams = ngram_hashes(h, n)
        whole = {m: ngram_hashes(h, m) ^ np.uint64(m) for m in range(1, n)}
        for i in range(hi - lo):
            first, count = starts[i], starts[i + 1] - starts[i]
            if count >= n:
                yield np.unique(grams[first:first + count - n + 1])
            else:
                yield whole[count][first:first + 1] if count else np.zeros(0, np.uint64)


def set_digest(members: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    return tuple(np.frombuffer(hashlib.blake2b(members.tobytes(), digest_size=16).digest(), np.int64).tolist())


def bitmap(members: np.ndarray) -> np.ndarray:
    """At least a bit per member, up to the largest bitmap; a power of two, so that halves can be folded.

    Sets of one bit per member still overlap in too few bits to link unless they do; bitmaps travel with each block.
    """
    width = 64
    while width < min(MOST_BITS, len(members)):
        width *= 2
    p = (members >> np.uint64(24)) & np.uint64(width - 1)
    bits = np.zeros(width, np.uint8)
    bits[p] = 1
    return np.packbits(bits, bitorder="little").view(np.uint64)


def prefix_length(size: int, percent: int) -> int:
    """So many members of one set, rarest first, include one of every set that it links with."""
    return size - -(-percent * size // 100) + 1


class Order:
    """Rare before frequent, by counters that members share; equal ones by hash. Any fixed order gives right results."""

    def __init__(self, counts: np.ndarray):
        mean = max(1.0, float(counts.mean()))
        self.level = np.clip(np.log2(np.maximum(counts, 1) / mean) * 4, 0, 60).astype(np.int8)

    def prefix(self, members: np.ndarray, percent: int) -> np.ndarray:
        level = self.level[members & np.uint64(COUNTERS - 1)]
        return members[np.argsort(level, kind="stable")[:prefix_length(len(members), percent)]]


def block_keys(members: np.ndarray, order: Order, percent: int) -> np.ndarray:
    """Two keys per prefix member: sets that share one are near enough in size to link.

    Sizes fall into classes a little wider than the ratio that links allow, so linked sets are in one class or in
    neighbours. A set takes part in its own class and the next.
    """
    size_class = int(np.log(len(members)) / (1.0001 * np.log(100 / percent))) if percent < 100 else len(members)
    prefix = order.prefix(members, percent)
    return np.concatenate([mix64(prefix + np.uint64((size_class + k) * 0x9E3779B97F4A7C15 % (1 << 64))) for k in (1, 2)])


def described(docs: DataFrame, n: int) -> DataFrame:
    """Per row ``(doc, text, size, d1, d2, bits)``, ``text`` being the text's MD5, and the tasks' counters as rows with a
    ``block``; written once."""
    kind = docs.schema["js_doc"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.int64)
        doc_type = None
        for batch in batches:
            size, d1, d2, bits = [], [], [], []
            doc_type = batch.column("js_doc").type
            for members in shingle_sets(batch.column("js_text"), n):
                size.append(len(members))
                one, two = set_digest(members)
                d1.append(one)
                d2.append(two)
                bits.append(bitmap(members).tobytes())
                np.add.at(counts, members & np.uint64(COUNTERS - 1), 1)
            k = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column("js_doc"), batch.column("js_md5"), pa.array(size, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()),
                 pa.array(bits, pa.binary()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())],
                ["doc", "text", "size", "d1", "d2", "bits", "block", "counts"])
        if doc_type is not None:
            parts = counts.reshape(-1, COUNTER_BLOCK)
            k = len(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(k, doc_type), pa.nulls(k, pa.binary()), *[pa.nulls(k, pa.int64())] * 3, pa.nulls(k, pa.binary()), pa.array(range(k), pa.int32()),
                 pa.array([p.astype(np.uint32).tobytes() for p in parts])],
                ["doc", "text", "size", "d1", "d2", "bits", "block", "counts"])

    return written(docs.mapInArrow(
        work, f"doc {kind}, text binary, size long, d1 long, d2 long, bits binary, block int, counts binary"), "sets")


def member_order(rows: DataFrame) -> Broadcast:
    """Add up the tasks' counters; their number is fixed."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist()):
                sums = total.setdefault(block, np.zeros(COUNTER_BLOCK, np.int64))
                sums += np.frombuffer(counts, np.uint32)
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()),
                                              pa.array([v.tobytes() for v in total.values()])], ["block", "counts"])

    parts = rows.where(F.col("block").isNotNull()).select("block", "counts").repartition(8, "block")
    counts = np.zeros(COUNTERS, np.int64)
    for r in parts.mapInArrow(add, "block int, counts binary").collect():
        counts[r["block"] * COUNTER_BLOCK:(r["block"] + 1) * COUNTER_BLOCK] = np.frombuffer(r["counts"], np.int64)
    return rows.sparkSession.sparkContext.broadcast(Order(counts))


# --- blocks ----------------------------------------------------------------------------------------

def representatives(classes: DataFrame, n_classes: int) -> Broadcast:
    """A filter of the pairs of ``d1`` and ``rep`` by which copies are left aside."""

    def ids(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        yield _row_ids(batch.column("d1").to_numpy(), batch.column("rep").to_numpy())

    return bloom.build(classes.select("d1", "rep"), ids, n_classes, at_least=1, stored=True)


def _row_ids(d1: np.ndarray, doc: np.ndarray) -> np.ndarray:
    return mix64(d1.view(np.uint64) ^ mix64(doc.view(np.uint64)))


def chosen_sets(batch: pa.RecordBatch, n: int, chosen: bloom.Filter) -> Iterator[tuple[tuple[int, int], np.ndarray]]:
    """``(digest, members)`` of the rows that stand for a set in ``chosen``, and of few others; none is empty."""
    for doc, members in zip(batch.column("js_doc").to_pylist(), shingle_sets(batch.column("js_text"), n)):
        if doc is not None and len(members):
            d = set_digest(members)
            if chosen.hits(_row_ids(np.array([d[0]], np.int64), np.array([doc], np.int64)))[0]:
                yield d, members


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by ``(token, d1)`` the distinct ones whose token two sets have; the last row of a batch waits for
    the next."""
    token, d1, before = np.zeros(0, np.int64), np.zeros(0, np.int64), False
    for batch in batches:
        token, d1 = (np.concatenate([held, batch.column(c).to_numpy()]) for held, c in ((token, "token"), (d1, "d1")))
        if not len(token):
            continue
        new = np.concatenate([[True], (token[1:] != token[:-1]) | (d1[1:] != d1[:-1])])
        token, d1 = token[new], d1[new]
        same = token[1:] == token[:-1]
        met = np.concatenate([[before], same])  # with the row before
        met[:-1] |= same  # or the one after
        yield pa.RecordBatch.from_arrays([pa.array(x[:-1][met[:-1]]) for x in (token, d1)], ["token", "d1"])
        token, d1, before = token[-1:], d1[-1:], bool(met[-1])
    if before:
        yield pa.RecordBatch.from_arrays([pa.array(token), pa.array(d1)], ["token", "d1"])


def memberships(docs: DataFrame, n: int, percent: int, order: Broadcast, chosen: Broadcast,
                n_members: int) -> tuple[DataFrame, list[DataFrame]]:
    """``(block, d1, sets)``: which sets meet in which block of ``sets`` sets; and the written tables it reads.

    Half a digest will do here: two sets with one half only meet in each other's blocks as well. Of copies only the
    ``chosen`` row takes part, so that they are no reason to keep a prefix member.

    A prefix member that the twice-seen filter rules out is in no other prefix. Those that it lets pass without need
    are left out when sorted, before anything is written. Blocks with the same sets are one.
    """

    def prefixes(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for _, members in chosen_sets(batch, n, chosen.value):
            yield block_keys(members, order.value, percent)

    twice = bloom.build(docs.select("js_doc", "js_text"), prefixes, 2 * n_members, stored=True)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, d1 = [], []
            for d, members in chosen_sets(batch, n, chosen.value):
                prefix = block_keys(members, order.value, percent)
                prefix = prefix[twice.value.hits(prefix)]
                if len(prefix):
                    tokens.append(prefix.view(np.int64))
                    d1.append(np.full(len(prefix), d[0], np.int64))
            if tokens:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (tokens, d1)], ["token", "d1"])

    rows = docs.select("js_doc", "js_text").mapInArrow(work, "token long, d1 long")
    rows = rows.repartition("token").sortWithinPartitions("token", "d1").mapInArrow(_met, "token long, d1 long")
    rows = written(rows, "prefixes")
    twice.destroy()
    alike = [F.bit_xor(F.xxhash64("d1", F.lit(k))).alias(f"x{k}") for k in (1, 2)]
    blocks = rows.groupBy("token").agg(F.count("*").alias("sets"), *alike)
    blocks = written(blocks.groupBy("sets", "x1", "x2").agg(F.min("token").alias("block")).select("block", "sets"), "blocks")
    return rows.join(blocks, F.col("token") == F.col("block")).select("block", "d1", "sets"), [rows, blocks]


def members_of(docs: DataFrame, wanted: DataFrame, n: int, n_wanted: int) -> DataFrame:
    """``(d1, d2, members)`` of the wanted sets, once each; of copies only rows with the key ``rep`` send theirs."""
    chosen = representatives(wanted, n_wanted)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(*d, members.tobytes()) for d, members in chosen_sets(batch, n, chosen.value)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], ["d1", "d2", "members"])

    found = docs.select("js_doc", "js_text").mapInArrow(work, "d1 long, d2 long, members binary")
    return found.groupBy("d1", "d2").agg(F.first("members").alias("members"))


# --- trees -----------------------------------------------------------------------------------------

class Tree:
    """Nodes over sets in order of size: OR of the bitmaps, least and largest size, largest excess.

    The excess of a set is its size less the bits it sets. Two sets overlap in at most the common bits plus the
    smaller excess, and so do any two sets of two nodes.
    """

    def __init__(self, size: np.ndarray, bits: np.ndarray):
        self.by_size = np.argsort(size, kind="stable")
        size, bits = size[self.by_size], bits[self.by_size]
        self.levels = [(bits, size, size, size - np.bitwise_count(bits).sum(axis=1))]
        while len(self.levels[-1][1]) > 1:
            bits, low, high, excess = self.levels[-1]
            at = np.arange(0, len(low), FAN)
            self.levels.append((np.bitwise_or.reduceat(bits, at), np.minimum.reduceat(low, at),
                                np.maximum.reduceat(high, at), np.maximum.reduceat(excess, at)))

    def _possible(self, level: int, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
        bits, low, high, excess = self.levels[level]
        near = 100 * np.minimum(high[i], high[j]) >= percent * np.maximum(low[i], low[j])
        i, j, at = i[near], j[near], np.flatnonzero(near)
        most = np.minimum(excess[i], excess[j])
        for lo in range(0, len(i), 8192):
            most[lo:lo + 8192] += np.bitwise_count(bits[i[lo:lo + 8192]] & bits[j[lo:lo + 8192]]).sum(axis=1).astype(most.dtype)
        most = np.minimum(most, np.minimum(high[i], high[j]))
        return at[(100 + percent) * most >= percent * (low[i] + low[j])]

    def candidates(self, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of sets that the traversal of the tree against itself can't rule out."""
        i = j = np.zeros(1, np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            keep = self._possible(level, i, j, percent)
            i, j = i[keep], j[keep]
            if level:
                n = len(self.levels[level - 1][1])
                step = np.arange(FAN)
                a = np.broadcast_to(i[:, None, None] * FAN + step[:, None], (len(i), FAN, FAN)).reshape(-1)
                b = np.broadcast_to(j[:, None, None] * FAN + step[None, :], (len(j), FAN, FAN)).reshape(-1)
                ok = (a <= b) & (b < n)
                i, j = a[ok], b[ok]
        ok = i < j
        return self.by_size[i[ok]], self.by_size[j[ok]]


def candidates(size: np.ndarray, bits: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Candidate pairs of sets with bitmaps of any widths.

    Sets that can link are at most as many widths apart as their sizes' ratio allows, one from 50 percent on: a tree
    per width also holds the sets of the next ones, their bitmaps folded.
    """
    apart = int(np.ceil(np.log2(100 / percent)))
    width = np.array([len(b) for b in bits])
    found = []
    for w in np.unique(width):
        own = np.flatnonzero((width >= w) & (width <= w << apart))
        if len(own) < 2:
            continue
        folded = np.stack([np.bitwise_or.reduce(bits[i].reshape(-1, w), axis=0) for i in own])
        i, j = Tree(size[own], folded).candidates(percent)
        i, j = own[i], own[j]
        ok = (width[i] == w) | (width[j] == w)
        found.append((i[ok], j[ok]))
    if not found:
        return (np.zeros(0, np.int64),) * 2
    return tuple(np.concatenate(x) for x in zip(*found))


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int((b[at] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def forest(sets: list[np.ndarray], percent: int, side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that connect whatever the sets' links connect; with ``side``, only links between the sides count.

    A pair is compared unless links found before connect it already.
    """
    i, j = candidates(np.array([len(s) for s in sets]), [bitmap(s) for s in sets], percent)
    if side is not None:
        ok = side[i] != side[j]
        i, j = i[ok], j[ok]
    order = np.argsort(i, kind="stable")
    i, j = i[order], j[order]
    members, base, mark = None, np.concatenate([[0], np.cumsum([len(s) for s in sets])]), None
    group, links = np.arange(len(sets)), []
    for own in np.split(np.arange(len(i)), np.flatnonzero(np.diff(i)) + 1):
        if not len(own):
            continue
        a = int(i[own[0]])
        partners = j[own][group[j[own]] != group[a]]
        if len(partners) > 16:  # all overlaps of one set in one pass
            if members is None:
                _, members = np.unique(np.concatenate(sets), return_inverse=True)
                mark = np.zeros(len(members), bool)
            mark[members[base[a]:base[a + 1]]] = True
            both = np.add.reduceat(mark[members], base[:-1], dtype=np.int64)[partners]
            mark[members[base[a]:base[a + 1]]] = False
            either = np.diff(base)[partners] + len(sets[a]) - both
            partners, known = partners[100 * both >= percent * either], True
        else:
            known = False
        for b in partners.tolist():
            if group[a] != group[b] and (known or linked(sets[a], sets[b], percent)):
                links.append((a, b))
                group[group == group[b]] = group[a]
    return links


def _groups(batches: Iterator[pa.RecordBatch], key: list[str], flush) -> Iterator[pa.RecordBatch]:
    """Call ``flush(key, rows)`` for each run of rows with one key; rows are tuples of the other columns."""
    held, current = [], None
    for batch in batches:
        rest = [n for n in batch.schema.names if n not in key]
        for k, *row in zip(zip(*(batch.column(c).to_pylist() for c in key)), *(batch.column(c).to_pylist() for c in rest)):
            if k != current:
                if len(held) > 1:
                    yield from flush(current, held)
                held, current = [], k
            held.append(row)
    if len(held) > 1:
        yield from flush(current, held)


def dealt(rows: DataFrame, group: str, *columns: str) -> DataFrame:
    """Rows by ``(group, p, q)`` for tasks that compare the sets of a group, in order of that key.

    A group of more than ``BLOCK_SETS`` sets (column ``sets``) is dealt by hash into that many parts; every pair of
    parts is a task of its own, so no task gets a large group whole. ``first`` tells the sides of such a pair.
    """
    parts = F.ceil(F.col("sets") / F.lit(BLOCK_SETS)).cast("int")
    own = F.pmod(F.xxhash64("node"), parts).cast("int")
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    rows = rows.select(group, F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"),
                       (F.col("own") <= F.col("other")).alias("first"), "node", *columns)
    return rows.repartition(group, "p", "q").sortWithinPartitions(group, "p", "q")


def _sides(k: tuple, first: tuple) -> np.ndarray | None:
    return None if k[1] == k[2] else np.array(first)


def _edges(a, b) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def possible_links(rows: DataFrame, percent: int) -> DataFrame:
    """Edges ``(a, b)`` that connect all sets with a possible link, from rows ``(block, sets, size, bits, node)``, by
    signature trees alone."""

    def flush(k: tuple, held: list) -> Iterator[pa.RecordBatch]:
        first, node, size, bits = zip(*held)
        i, j = candidates(np.array(size), [np.frombuffer(b, np.uint64) for b in bits], percent)
        if (side := _sides(k, first)) is not None:
            ok = side[i] != side[j]
            i, j = i[ok], j[ok]
        root = np.arange(len(held))
        while len(i) and (root[i] != root[j]).any():
            least = np.minimum(root[i], root[j])
            np.minimum.at(root, i, least)
            np.minimum.at(root, j, least)
            root = root[root]
        moved = np.flatnonzero(root != np.arange(len(held)))
        if len(moved):
            node = np.array(node)
            yield _edges(node[root[moved]], node[moved])

    return dealt(rows, "block", "size", "bits").mapInArrow(
        lambda batches: _groups(batches, ["block", "p", "q"], flush), "a long, b long").distinct()


def exact_links(rows: DataFrame, percent: int) -> DataFrame:
    """``(a, b)`` links from rows ``(family, sets, node, members)``, as many as connect what is linked."""

    def flush(k: tuple, held: list) -> Iterator[pa.RecordBatch]:
        first, node, members = zip(*held)
        found = forest([np.frombuffer(m, np.uint64) for m in members], percent, _sides(k, first))
        if found:
            yield _edges(*([node[x] for x in ends] for ends in zip(*found)))

    return dealt(rows, "family", "members").mapInArrow(
        lambda batches: _groups(batches, ["family", "p", "q"], flush), "a long, b long")


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", n_words: int = N_WORDS,
         percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """``(rows, links)`` of the self-join of ``docs`` by Jaccard similarity of word shingles.

    ``rows`` has per row of ``docs`` the key ``doc``, the MD5 ``text``, the set's ``size``, its ``component`` (the
    smallest key that links reach), ``rep`` (the smallest key with the same set) and ``first``: whether key and set are
    those that stand for the component. ``links`` are exact links ``(a, b)`` between representatives that connect every
    component; pairs that they connect already are left out. Keys are integers; a key may stand for several texts.
    Texts without words have size 0 and link with nothing. A row with a NULL key takes its set's component, and none
    where no row with a key has that set. Repeated rows are copies; extra columns play no part.
    """
    with small_batches(docs.sparkSession), short_lived_shuffles(docs.sparkSession):
        return _joined(docs, key, text, n_words, percent)


def _joined(docs: DataFrame, key: str, text: str, n_words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    docs = docs.select(F.col(key).cast("long").alias("js_doc"), F.col(text).alias("js_text"),
                       F.unhex(F.md5(F.col(text))).alias("js_md5"))
    rows = described(docs, n_words)
    order = member_order(rows)
    slim = rows.where(F.col("block").isNull()).select("doc", "text", "size", "d1", "d2", "bits")
    classes = slim.where("size > 0").groupBy("d1", "d2").agg(
        F.min("doc").alias("rep"), F.first("size").alias("size"), F.first("bits").alias("bits"))
    # sets are numbered, as one key may be the smallest of several
    classes = classes.where(F.col("rep").isNotNull()).withColumn("node", F.monotonically_increasing_id())
    classes = written(classes, "classes")
    n_sets, n_members = classes.agg(F.count("*"), F.sum(F.col("size") * (100 - percent) / 100 + 1)).first()
    chosen = representatives(classes, n_sets)
    blocks, read = memberships(docs, n_words, percent, order, chosen, int(n_members or 1))
    possible = written(possible_links(blocks.join(classes, "d1"), percent), "possible")
    released(*read)
    order.destroy()
    chosen.destroy()
    # sets that possible links connect are compared as one family, so each set is sent once
    connected = components(possible)
    families = written(connected.withColumnRenamed("component", "family"), "families")
    wanted = families.join(classes, "node").select("d1", "d2", "rep", "node", "family")
    wanted = written(wanted.join(families.groupBy("family").agg(F.count("*").alias("sets")), "family"), "wanted")
    members = members_of(docs, wanted, n_words, wanted.count())
    links = exact_links(wanted.join(members, ["d1", "d2"]).select("family", "sets", "node", "members"), percent)
    links = written(links, "links")
    released(possible, connected, families, wanted)
    slim, classes = slim.drop("bits"), classes.select("node", "d1", "d2", "rep")
    connected = components(links)
    found = written(connected.join(classes, "node"), "found")
    released(connected)
    tops = found.groupBy("component").agg(F.min(F.struct("rep", "d1", "d2")).alias("top"))
    found = found.join(tops, "component").select("node", "top")
    own = F.struct("rep", "d1", "d2")
    named = classes.join(found, "node", "left").select(
        F.col("d1").alias("c1"), F.col("d2").alias("c2"), "rep", F.coalesce("top.rep", "rep").alias("component"),
        F.coalesce(F.col("top") == own, F.lit(True)).alias("top"))
    out = slim.join(named, (F.col("d1") == F.col("c1")) & (F.col("d2") == F.col("c2")) & (F.col("size") > 0), "left")
    empty = F.when(F.col("size") == 0, F.col("doc"))
    out = out.select("doc", "text", "size", F.coalesce("component", empty).alias("component"),
                     F.coalesce("rep", empty).alias("rep"),
                     (F.col("component").isNull() | F.col("top") & F.col("doc").eqNullSafe(F.col("component"))).alias("first"))
    key_of = classes.select("node", "rep")
    links = links.join(key_of.toDF("a", "from"), "a").join(key_of.toDF("b", "to"), "b").select(
        F.col("from").alias("a"), F.col("to").alias("b"))
    return out, links


def suspected(docs: DataFrame, md5: str, gone: DataFrame, n_gone: int, flag: str) -> DataFrame:
    """``docs`` with ``flag``: false only where the MD5 of a row's text, in column ``md5``, is none of those in ``gone``."""

    def halves(batch: pa.RecordBatch) -> np.ndarray:
        raw = b"".join(x or bytes(16) for x in batch.column(md5).to_pylist())
        return np.frombuffer(raw, np.uint64)[::2]

    def hashes(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        yield halves(batch)

    once = bloom.build(gone.select(md5), hashes, n_gone, at_least=1)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column(flag, pa.array(once.value.hits(halves(batch))))

    return docs.mapInArrow(work, widened(docs, **{flag: "boolean"}))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", n_words: int = N_WORDS,
                percent: int = PERCENT, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``docs`` with one row of each component: that with the smallest key (repeated rows of it are one).

    Rows without words are no one's copy and all stay; so do rows whose key is NULL and whose set no keyed row has.
    Each row is judged by its key and text, so rows that share a key, or have none, don't take each other along.
    Columns of any name pass through.

    Texts are not shuffled: the keys to leave out are sent to the rows if they have at most ``broadcast_bytes``. If
    they have more, a Bloom filter of them is sent, and only rows that it passes are shuffled.
    """
    rows, _ = join(docs, key, text, n_words, percent)
    mark = "js_"
    while any(c.lower().startswith(mark) for c in docs.columns):  # names that no column of docs has
        mark += "_"
    gone = rows.where(~F.col("first")).select(F.col("doc").alias(f"{mark}doc"), F.col("text").alias(f"{mark}md5"))
    with short_lived_shuffles(docs.sparkSession):
        gone = written(gone.distinct(), "copies")
    md5 = F.unhex(F.md5(F.col(text)))
    own = [F.col(f"`{c}`") for c in docs.columns]

    def kept(left: DataFrame, right: DataFrame) -> DataFrame:
        same = F.col(key).eqNullSafe(F.col(f"{mark}doc")) & (md5 == F.col(f"{mark}md5"))
        return left.join(right, same, "left_anti").select(*own)

    n_gone = gone.count()
    if 24 * n_gone <= broadcast_bytes:
        return kept(docs, F.broadcast(gone))
    flag = f"{mark}flag"
    docs = suspected(docs.withColumn(f"{mark}md5", md5), f"{mark}md5", gone, n_gone, flag).drop(f"{mark}md5")
    return docs.where(~F.col(flag)).select(*own).union(kept(docs.where(flag), gone))


def digest(docs: DataFrame) -> DataFrame:
    rows, _ = join(docs, n_words=4, percent=85)
    return rows.select(F.col("doc").alias("doc_id"), F.col("size").alias("n_shingles"),
                       F.col("component").alias("component_id"))
