"""SentencePiece encoding and decoding: distinct sampled segmentations by Gumbel top-k over the piece lattice.

Every segmentation has a perturbed log-probability: its own plus Gumbel noise. The k largest are a sample of k without
replacement. They are found by best-first search from the top: a node's value is the largest perturbed value below
it, a chosen child inherits it, and the children not chosen share a value that is drawn below it. Values only fall on
the way down, so a segmentation that is reached is the next best. All noise is derived from the row's key.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .textbytes import chunks, mix64, powers

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Samples per text, and sharpness of the distribution over segmentations.
SAMPLES, ALPHA = 2, 1.0
#: Bytes of text whose lattices a task holds at once; each takes some hundred times its size.
CHUNK = 1 << 18
#: Stands for the white space mark; it occurs in no UTF-8 text.
MARK = 0xFF
NEWLINE = 10

_TABLE = np.random.Generator(np.random.PCG64(5)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


# --- vocabulary ------------------------------------------------------------------------------------

class Vocabulary:
    """Pieces with log-probabilities. A merge list has ranks instead; probabilities then follow Zipf's law."""

    def __init__(self, pieces: list[bytes], ids: list[int], log_p: np.ndarray, byte_ids: list[int], byte_log_p: float):
        self.pieces, self.ids, self.log_p = pieces, np.array(ids), log_p
        self.byte_ids, self.byte_log_p = np.array(byte_ids), byte_log_p

    @classmethod
    def load(cls, path: str = MODEL, alpha: float = ALPHA) -> "Vocabulary":
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        plain = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        pieces = [model.id_to_piece(i).replace("▁", "\0").encode().replace(b"\0", bytes([MARK])) for i in plain]
        rank = np.minimum(-np.array([model.get_score(i) for i in plain]), size)
        log_p = -np.log(rank + 3.0)
        total = np.log(np.exp(log_p).sum())
        return cls(pieces, plain, alpha * (log_p - total), byte_ids, float(alpha * (-np.log(size + 3.0) - total - 1)))

    def _hashes(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of pieces of ``length`` bytes or more, and the hashes of their first ``length`` bytes."""
        data, place, size = self._bytes
        up, down = powers(len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_TABLE[data] * up[:len(data)], out=sums[1:])
        own = np.flatnonzero(size >= length)
        return own, (sums[place[own] + length] - sums[place[own]]) * down[place[own]]

    @cached_property
    def _bytes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = np.array([len(p) for p in self.pieces])
        return np.frombuffer(b"".join(self.pieces), np.uint8), np.cumsum(size) - size, size

    @cached_property
    def by_length(self) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """Per length in bytes the sorted hashes of pieces, and their numbers."""
        found, size = [], self._bytes[2]
        for n in np.unique(size).tolist():
            own, h = self._hashes(n)
            own, h = own[size[own] == n], h[size[own] == n]
            order = np.argsort(h, kind="stable")
            found.append((n, h[order], own[order]))
        return found

    @cached_property
    def seen(self) -> np.ndarray:
        """By leading hash bits: 1 if any piece has them, plus 2 if the beginning of a longer one has."""
        marks, size = np.zeros(1 << 22, np.uint8), self._bytes[2]
        for n, _, _ in self.by_length:
            own, h = self._hashes(n)
            at, longer = (h >> np.uint64(42)).astype(np.int64), size[own] > n
            marks[at[~longer]] |= 1
            marks[at[longer]] |= 2
        return marks

    @cached_property
    def decoded(self) -> dict[int, bytes]:
        back = {int(i): p.replace(bytes([MARK]), b" ") for i, p in zip(self.ids, self.pieces)}
        return back | {int(i): bytes([b]) for b, i in enumerate(self.byte_ids)}

    @cached_property
    def flat(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What each id stands for, as places and lengths in one row of bytes."""
        back = [self.decoded.get(i, b"") for i in range(max(self.decoded) + 1)]
        size = np.array([len(x) for x in back])
        return np.frombuffer(b"".join(back), np.uint8), np.cumsum(size) - size, size

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of a segmentation, without the blank put before it."""
        data, place, size = self.flat
        each = size[ids]
        base = np.cumsum(each)
        shift = np.repeat(place[ids] - base + each, each)
        shift += np.arange(len(shift))
        return data[shift].tobytes()[1:]


# --- lattice ---------------------------------------------------------------------------------------

@dataclass
class Lattice:
    """The lattices of distinct units, one after the other; positions count bytes, edges are ordered by start."""

    start: np.ndarray  # first and last position per unit
    stop: np.ndarray
    first: np.ndarray  # first edge per position, and behind the last
    end: np.ndarray  # per edge: where it ends, its piece (-1: the bytes themselves), its probability at its start
    piece: np.ndarray
    p: np.ndarray
    log_p: np.ndarray
    upto: np.ndarray  # running total of p at the start
    only: np.ndarray  # whether no other edge starts there


def lattice(data: np.ndarray, start: np.ndarray, stop: np.ndarray, vocabulary: Vocabulary) -> Lattice:
    """Edges of all pieces that occur in the units ``data[start:stop]``, weighted by what can follow them.

    A character without a piece has one edge, spelled in bytes.
    """
    size = stop - start
    base = np.concatenate([[0], np.cumsum(size)])
    within = np.arange(base[-1]) - np.repeat(base[:-1], size)
    u = data[np.repeat(start, size) + within]
    n = len(u)
    up, down = powers(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_TABLE[u] * up[:n], out=sums[1:])
    last = np.repeat(base[1:], size)
    head = (u & 0xC0) != 0x80
    head[u == MARK] = True
    heads = np.flatnonzero(head)
    a, z, k = [], [], []
    single = np.zeros(n, bool)
    following = np.append(heads[1:], n)
    char_end = np.zeros(n + 1, np.int64)
    char_end[heads] = np.minimum(following, last[heads]) if len(heads) else following
    room, left, before, back = heads, last[heads] - heads, sums[heads], down[heads]
    seen, goes_on, widest = vocabulary.seen, np.ones(len(heads), bool), int((char_end[heads] - heads).max(initial=0))
    for length, hashes, numbers in vocabulary.by_length:
        fits = np.flatnonzero(goes_on & (left >= length))
        if len(fits) < len(room):  # the others have no room, or begin no longer piece
            room, left, before, back = room[fits], left[fits], before[fits], back[fits]
        h = (sums[room + length] - before) * back
        mark = seen[(h >> np.uint64(42)).astype(np.int64)]
        goes_on = mark > 1
        hit = np.flatnonzero(mark & 1)
        at, h = room[hit], h[hit]
        place = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
        ok = hashes[place] == h
        at, place = at[ok], place[ok]
        a.append(at.astype(np.int32))
        z.append((at + length).astype(np.int32))
        k.append(numbers[place].astype(np.int32))
        if length <= widest:
            single[at[char_end[at] == at + length]] = True
    bare = heads[~single[heads]]
    a, z, k = (np.concatenate([*x, more.astype(np.int32)]) for x, more in (
        (a, bare), (z, char_end[bare]), (k, np.full(len(bare), -1))))
    order = np.argsort(a, kind="stable").astype(np.int32)
    a, z, k = a[order], z[order], k[order]
    del order, sums, up, down, within
    cost = np.where(k >= 0, vocabulary.log_p[k], vocabulary.byte_log_p * (z - a))
    each = np.bincount(a, minlength=n)
    first = np.concatenate([[0], np.cumsum(each)])
    # what can follow, from the ends of the units backwards; nothing does behind the end, which has the last place
    total = np.full(n + 2, -np.inf)
    total[n + 1] = 0.0
    end = np.repeat(last, each)
    distance = end - a
    longest = int(distance.max(initial=0))
    by_distance = np.argsort(distance.astype(np.int16) if longest < 1 << 15 else distance, kind="stable")
    cuts = np.cumsum(np.bincount(distance, minlength=longest + 1))
    begin, onto = a[by_distance], np.where(z == end, n + 1, z)[by_distance]
    value = cost[by_distance]
    new = np.flatnonzero(np.append(True, begin[1:] != begin[:-1])) if len(begin) else begin
    at = begin[new]
    new_cuts = np.searchsorted(new, cuts)
    for lo, hi, one, two in zip(cuts[:-1].tolist(), cuts[1:].tolist(), new_cuts[:-1].tolist(), new_cuts[1:].tolist()):
        if lo == hi:
            continue
        value[lo:hi] += total[onto[lo:hi]]
        total[at[one:two]] = np.logaddexp.reduceat(value[lo:hi], new[one:two] - lo)
    follow = np.empty(len(a))
    follow[by_distance] = value
    del cost, by_distance, distance, begin, onto, value, end
    log_p = np.minimum(follow - np.repeat(total[:n], each), 0.0)
    del follow
    p = np.exp(log_p)
    running = np.cumsum(p)
    upto = running - np.repeat(np.append(0.0, running)[first[:-1]], each)
    upto[first[1:][each > 0] - 1] = np.inf  # the last edge takes what rounding leaves
    return Lattice(base[:-1], base[1:], first, z, k, p, log_p, upto, np.repeat(each == 1, each))


# --- sampling --------------------------------------------------------------------------------------

def uniform(seed: np.ndarray, stream: int, step=0) -> np.ndarray:
    """Numbers in (0, 1) that depend on the arguments alone."""
    shift = np.asarray(step).astype(np.uint64) * np.uint64(0xD1342543DE82EF95) + np.uint64(stream * 0x9E3779B97F4A7C15 % (1 << 64))
    return ((mix64(seed + shift) >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0 ** -52


def walks(lat: Lattice, at: np.ndarray, stop: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A random path from each position to the end of its unit: edges, and how many each path has."""
    count, steps = np.zeros(len(at), np.int64), []
    on, at = np.arange(len(at)), at.copy()
    done = at >= stop
    on = on[~done]
    t = 0
    while len(on):
        x = uniform(seed[on], 1, t)
        e = lat.first[at[on]]
        wait = np.flatnonzero(x > lat.upto[e])
        while len(wait):
            e[wait] += 1
            wait = wait[x[wait] > lat.upto[e[wait]]]
        steps.append((on, e))
        at[on] = lat.end[e]
        count[on] += 1
        on = on[at[on] < stop[on]]
        t += 1
    base = np.concatenate([[0], np.cumsum(count)])
    out = np.zeros(base[-1], np.int64)
    for t, (on, e) in enumerate(steps):
        out[base[on] + t] = e
    return out, count


def below(value: np.ndarray, log_mass: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The largest of Gumbel values with this mass, given that it lies below ``value``; -inf without mass."""
    with np.errstate(divide="ignore", invalid="ignore"):
        drawn = -np.logaddexp(-value, -log_mass + np.log(-np.log(x)))
    return np.where(np.isneginf(log_mass), -np.inf, drawn)


@dataclass
class Paths:
    """One segmentation per text: edges of all texts in a row, and the value of what each step leaves open."""

    base: np.ndarray
    edge: np.ndarray
    occurrence: np.ndarray
    log_p: np.ndarray  # before each step
    total: np.ndarray
    value: np.ndarray
    open: np.ndarray


def _paths(lat: Lattice, edge, occurrence, count, value, opened, seed, number) -> Paths:
    """``opened``: per text the first step whose siblings are still to be given a value."""
    base = np.concatenate([[0], np.cumsum(count)])
    text = np.repeat(np.arange(len(count)), count)
    sums = np.concatenate([[0.0], np.cumsum(lat.log_p[edge])])
    before = sums[:-1] - sums[base[:-1]][text]
    p = lat.p[edge]
    with np.errstate(divide="ignore"):
        rest = before + np.log1p(-np.minimum(p, 1.0))
    step = np.arange(base[-1]) - base[:-1][text]
    able = np.flatnonzero(~lat.only[edge] & (step >= opened[text]))
    free = np.full(len(edge), -np.inf)
    free[able] = below(value[text[able]], rest[able], uniform(seed[text[able]], 100 + number, step[able]))
    return Paths(base, edge, occurrence, before, sums[base[1:]] - sums[base[:-1]], value, free)


def _largest(paths: list[Paths], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text the largest open value, the path that has it and the step."""
    best, which, place = np.full(n, -np.inf), np.full(n, -1), np.full(n, -1)
    for k, p in enumerate(paths):
        own = np.flatnonzero(np.diff(p.base) > 0)
        if not len(own):
            continue
        top = np.full(n, -np.inf)
        top[own] = np.maximum.reduceat(p.open, p.base[:-1][own])
        new = top > best
        if not new.any():
            continue
        text = np.repeat(np.arange(n), np.diff(p.base))
        hit = np.flatnonzero((p.open == top[text]) & new[text])
        best[new], which[new] = top[new], k
        place[text[hit[::-1]]] = hit[::-1]
    return best, which, place


def segmentations(data: np.ndarray, offsets: np.ndarray, seed: np.ndarray, vocabulary: Vocabulary,
                  k: int) -> Iterator[tuple[int, int, np.ndarray, float, float, float]]:
    """``(text, sample, piece ids, log-probability, perturbed value, log of inclusion probability)``.

    Samples of a text are distinct and in order of perturbed value; a text with fewer segmentations has them all. The
    inclusion probability is that of a value above the largest one not taken; it is 1 where none is left.
    """
    n = len(offsets) - 1
    size = np.diff(offsets)
    # a blank before each text that isn't empty; blanks become marks
    body = np.where(data == 32, np.uint8(MARK), data)
    d = np.insert(body, offsets[:-1][size > 0], np.uint8(MARK))
    off = offsets + np.concatenate([[0], np.cumsum(size > 0)])
    mark, line = d == MARK, d == NEWLINE
    new = np.zeros(len(d) + 1, bool)
    new[off] = True
    if len(d):
        new[1:-1] |= (mark[1:] & ~mark[:-1]) | line[1:] | line[:-1]
    new[len(d)] = True
    edges_at = np.flatnonzero(new)
    start, stop = edges_at[:-1], edges_at[1:]
    text_of = np.searchsorted(off, start, side="right") - 1
    up, down = powers(len(d))
    sums = np.zeros(len(d) + 1, np.uint64)
    np.cumsum(_TABLE[d] * up[:len(d)], out=sums[1:])
    _, one, unit = np.unique(mix64((sums[stop] - sums[start]) * down[start]), return_index=True, return_inverse=True)
    lat = lattice(d, start[one], stop[one], vocabulary)
    first_unit = np.searchsorted(text_of, np.arange(n + 1))
    number = np.arange(len(start)) - first_unit[text_of]
    noise = mix64(seed[text_of] ^ mix64(number.astype(np.uint64)))

    edge, count = walks(lat, lat.start[unit], lat.stop[unit], noise)
    per_text = np.bincount(text_of, count, n).astype(np.int64)
    root = -np.log(-np.log(uniform(seed, 2)))
    paths = [_paths(lat, edge, np.repeat(np.arange(len(unit)), count), per_text, root, np.zeros(n, np.int64), seed, 0)]
    alive = [np.ones(n, bool)]
    chosen: dict[tuple[int, int], list[int]] = {}
    for r in range(1, k):
        best, which, place = _largest(paths, n)
        on = np.isfinite(best)
        turn, at, fork = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        for t in np.flatnonzero(on).tolist():
            parent, x = paths[which[t]], int(place[t])
            e = int(parent.edge[x])
            node = int(np.searchsorted(lat.first, e, side="right")) - 1
            taken = chosen.setdefault((int(which[t]), x), [e])
            left = np.array([x for x in range(lat.first[node], lat.first[node + 1]) if x not in taken])
            weight = np.cumsum(lat.p[left])
            draw = float(uniform(seed[t:t + 1], 200 + r)[0])
            pick = int(left[min(np.searchsorted(weight, draw * weight[-1]), len(left) - 1)])
            taken.append(pick)
            rest = lat.p[left].sum() - lat.p[pick]
            log_rest = parent.log_p[x] + np.log(rest) if len(left) > 1 and rest > 0 else -np.inf
            # the siblings still left share a value below that of the one just chosen
            parent.open[x] = below(best[t:t + 1], np.array([log_rest]), uniform(seed[t:t + 1], 300 + r))[0]
            turn[t], at[t], fork[t] = pick, lat.end[pick], x
        # the parents' steps, the new edge, and fresh walks to the end
        occurrence = np.array([paths[w].occurrence[x] if w >= 0 else 0 for w, x in zip(which, place)], np.int64)
        texts = np.flatnonzero(on)
        later = [np.arange(occurrence[t], first_unit[t + 1]) for t in texts]
        units = np.concatenate(later) if later else np.zeros(0, np.int64)
        begin = lat.start[unit[units]]
        heads = np.concatenate([[0], np.cumsum([len(x) for x in later])])[:-1].astype(np.int64)
        begin[heads] = at[texts]
        fresh, fresh_count = walks(lat, begin, lat.stop[unit[units]], mix64(noise[units] + np.uint64(r)))
        fresh_base = np.concatenate([[0], np.cumsum(fresh_count)])
        fresh_occurrence = np.repeat(units, fresh_count)
        edges, occurrences, counts, opened = [], [], np.zeros(n, np.int64), np.zeros(n, np.int64)
        ends = np.append(heads[1:], len(units))
        for t, lo, hi in zip(texts.tolist(), heads.tolist(), ends.tolist()):
            parent, x = paths[which[t]], int(place[t])
            b, f, g = parent.base[t], fresh_base[lo], fresh_base[hi]
            edges += [parent.edge[b:x], turn[t:t + 1], fresh[f:g]]
            occurrences += [parent.occurrence[b:x + 1], fresh_occurrence[f:g]]
            counts[t], opened[t] = x - b + 1 + g - f, x - b + 1
        none = np.zeros(0, np.int64)
        paths.append(_paths(lat, np.concatenate(edges or [none]), np.concatenate(occurrences or [none]), counts,
                            np.where(on, best, 0.0), opened, seed, r))
        alive.append(on)
    limit, _, _ = _largest(paths, n)
    ids = np.where(lat.piece >= 0, vocabulary.ids[lat.piece], -1)
    spelled = _spelled(lat, d, start[one], vocabulary)
    for e, own in spelled.items():
        if len(own) == 1:
            ids[e] = own[0]
    for r, p in enumerate(paths):
        own = ids[p.edge]
        for t in np.flatnonzero(alive[r]).tolist():
            found = own[p.base[t]:p.base[t + 1]]
            if len(found) and found.min() < 0:
                found = np.array([y for x, e in zip(found.tolist(), p.edge[p.base[t]:p.base[t + 1]].tolist())
                                  for y in ((x,) if x >= 0 else spelled[e])])
            inclusion = 0.0
            if np.isfinite(limit[t]):
                gap = p.total[t] - limit[t]
                inclusion = float(np.log(-np.expm1(-np.exp(gap)))) if gap > -30 else float(gap)
            yield t, r, found, float(p.total[t]), float(p.value[t]), inclusion


def _spelled(lat: Lattice, data: np.ndarray, start: np.ndarray, vocabulary: Vocabulary) -> dict[int, list[int]]:
    """The byte ids of edges without a piece."""
    found = {}
    for e in np.flatnonzero(lat.piece < 0).tolist():
        at = int(np.searchsorted(lat.first, e, side="right")) - 1
        u = int(np.searchsorted(lat.start, at, side="right")) - 1
        raw = data[start[u] + at - lat.start[u]:start[u] + int(lat.end[e]) - lat.start[u]]
        found[e] = [int(vocabulary.byte_ids[32 if b == MARK else b]) for b in raw.tolist()]
    return found


# --- tables ----------------------------------------------------------------------------------------

def sampled(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = SAMPLES, model: str = MODEL,
            alpha: float = ALPHA, with_ids: bool = True) -> DataFrame:
    """Up to ``k`` distinct segmentations per row: ``key``, ``sample`` (from 0), ``ids`` or their CRC-32 as
    ``ids_crc32``, ``n_pieces``, ``log_prob``, ``perturbed``, ``log_inclusion`` and ``decoded`` (whether the pieces
    give the text back).

    The noise depends on the key alone, so rows with equal key and text are sampled alike; rows with NULL keys share
    one. A NULL or empty text has one segmentation, without pieces. Other columns are left out. The vocabulary, of
    bounded size, is read once from ``model`` and sent to the tasks.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(model, alpha))
    last = T.StructField("ids", T.ArrayType(T.IntegerType())) if with_ids else T.StructField("ids_crc32", T.LongType())
    schema = T.StructType([T.StructField(key, docs.schema[key].dataType), *T.StructType.fromDDL(
        "sample int, n_pieces long, log_prob double, perturbed double, log_inclusion double, decoded boolean").fields, last])
    rows = docs.select(F.col(key).alias("sp_key"), F.xxhash64(F.col(key)).alias("sp_seed"), F.col(text).alias("sp_text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary.value
        for batch in batches:
            seeds = batch.column("sp_seed").to_numpy().view(np.uint64)
            for lo, hi, data, offsets in chunks(batch.column("sp_text"), CHUNK):
                raw, out = data.tobytes(), []
                for t, r, ids, log_prob, value, inclusion in segmentations(data, offsets, mix64(seeds[lo:hi]), own, k):
                    same = own.decode(ids) == raw[offsets[t]:offsets[t + 1]]
                    kept = ids.astype(np.int32) if with_ids else zlib.crc32(ids.astype("<i4").tobytes())
                    out.append((lo + t, r, len(ids), log_prob, value, inclusion, same, kept))
                at, *columns = zip(*out)
                kinds = [pa.int32(), pa.int64(), *[pa.float64()] * 3, pa.bool_(), pa.list_(pa.int32()) if with_ids else pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("sp_key").take(pa.array(at)), *[pa.array(c, kind) for c, kind in zip(columns, kinds)]],
                    schema.names)

    return rows.mapInArrow(work, schema)


def digest(docs: DataFrame) -> DataFrame:
    """Two segmentations per document; their ids as CRC-32."""
    return sampled(docs.select("doc_id", "text"), with_ids=False)
