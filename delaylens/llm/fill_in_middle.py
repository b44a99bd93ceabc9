"""Fill-in-the-middle: texts are kept as independent compressed frames, only frames that hold a cut are opened."""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from .common import slices, widened

#: Bytes of text in a frame.
FRAME = 1 << 16
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN_PERCENT, SPM_PERCENT = 10, 20
#: The marks of each form in the order of the output.
ORDER = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


def unit_starts(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where units (runs of A-Za-z, else single characters) and where characters begin in UTF-8 bytes."""
    letter, begins = _LETTER[data], (data & 0xC0) != 0x80
    units = begins.copy()
    units[1:] &= ~(letter[1:] & letter[:-1])
    return units, begins


def frames_of(text: bytes, size: int, packer: zstandard.ZstdCompressor) -> list[dict]:
    """Frames of at most ``size`` bytes of whole characters, with the units and characters begun up to their ends."""
    data = np.frombuffer(text, np.uint8)
    units, begins = (np.cumsum(x) for x in unit_starts(data))
    found, first, size = [], 0, max(4, size)  # a character has up to four bytes
    while first < len(text):
        last = min(len(text), first + size)
        while last < len(text) and data[last] & 0xC0 == 0x80:
            last -= 1
        found.append({"units": int(units[last - 1]), "chars": int(begins[last - 1]), "data": packer.compress(text[first:last])})
        first = last
    return found


class Seekable:
    """Frames with cumulative counts; the frame opened last stays open."""

    def __init__(self, frames: list[dict], opener: zstandard.ZstdDecompressor):
        self.frames, self.opener = frames, opener
        self.ends = [f["units"] for f in frames]
        self.at, self.bytes = -1, b""

    def opened(self, k: int) -> bytes:
        if self.at != k:
            self.at, self.bytes = k, self.opener.decompress(self.frames[k]["data"])
        return self.bytes

    def cut(self, unit: int) -> tuple[int, int, int]:
        """Frame, byte in it and characters before, where unit number ``unit`` begins."""
        k = bisect_right(self.ends, unit)
        if k == len(self.frames):  # after the last unit
            return k, 0, self.frames[-1]["chars"] if self.frames else 0
        before, chars = (self.ends[k - 1], self.frames[k - 1]["chars"]) if k else (0, 0)
        units, begins = unit_starts(np.frombuffer(self.opened(k), np.uint8))
        starts = np.flatnonzero(units)
        starts = starts[len(starts) - (self.ends[k] - before):]  # a run of letters may go on from the frame before
        byte = int(starts[unit - before])
        return k, byte, chars + int(begins[:byte].sum())

    def part(self, first: tuple[int, int], last: tuple[int, int]) -> Iterator[tuple[bytes | None, bytes]]:
        """Between two cuts: ``(compressed, b"")`` for whole frames, ``(None, bytes)`` for pieces of frames."""
        for k in range(first[0], min(last[0] + 1, len(self.frames))):
            a, b = first[1] if k == first[0] else 0, last[1] if k == last[0] else None
            if a == 0 and b is None:
                yield self.frames[k]["data"], b""
            elif b is None or a < b:
                yield None, self.opened(k)[a:b]

    def holds(self, marks: Iterable[bytes]) -> bool:
        tail = b""
        for k in range(len(self.frames)):
            text = tail + self.opened(k)
            if any(m in text for m in marks):
                return True
            tail = text[-2:]
        return False


def output_frames(text: Seekable, form: str, cuts: list[tuple[int, int]], size: int,
                  packer: zstandard.ZstdCompressor) -> Iterator[bytes]:
    """Frames of the output; whole frames are taken over as they are."""
    start, end = (0, 0), (len(text.frames), 0)
    parts = {PREFIX: (start, cuts[0]), MIDDLE: (cuts[0], cuts[1]), SUFFIX: (cuts[1], end)}
    waiting = b""
    for mark in ORDER[form]:
        waiting += mark
        for whole, piece in text.part(*parts[mark]):
            waiting += piece
            if waiting and (whole is not None or len(waiting) >= size):
                yield packer.compress(waiting)
                waiting = b""
            if whole is not None:
                yield whole
    if waiting:
        yield packer.compress(waiting)


def rebuilt(frames: list[bytes], form: str, opener: zstandard.ZstdDecompressor) -> Iterator[bytes]:
    """The text of an output, from its frames and form alone: one pass finds the marks, one more gives the parts."""
    if form == "plain":
        for f in frames:
            yield opener.decompress(f)
        return
    one, two, three = ORDER[form]
    ends, found, tail, kept = [0], [], b"", (-1, b"")
    for k, f in enumerate(frames):
        kept = k, opener.decompress(f)
        text, base = tail + kept[1], ends[-1] - len(tail)
        for mark in (two, three)[len(found):]:
            at = text.find(mark, max(0, found[-1] + 3 - base) if found else 0)
            if at < 0:
                break
            found.append(base + at)
        ends.append(ends[-1] + len(kept[1]))
        tail = text[-2:]
    spans = {one: (3, found[0]), two: (found[0] + 3, found[1]), three: (found[1] + 3, ends[-1])}
    for mark in (PREFIX, MIDDLE, SUFFIX):
        first, last = spans[mark]
        for k in range(bisect_right(ends, first) - 1, len(frames)):
            if ends[k] >= last:
                break
            if kept[0] != k:
                kept = k, opener.decompress(frames[k])
            yield kept[1][max(0, first - ends[k]):last - ends[k]]


def _own(df: DataFrame, *also: str) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in df.columns if not c.startswith("fm_") or c in also])


def stored(docs: DataFrame, text: str = "text", frame: int = FRAME, level: int = 3) -> DataFrame:
    """``docs`` with ``text`` as frames in ``fm_frames``: each an independent Zstandard frame of up to ``frame`` bytes
    with the units and characters begun up to its end.

    A NULL or empty text has no frames. Columns whose names begin with ``fm_`` are replaced, all others, ``text``
    included, pass through; repeated rows stay and an empty table stays empty. A frame ends at a character, also
    inside a long run of letters, so frames of any text are bounded.
    """
    docs = _own(docs)
    names = docs.columns
    schema = widened(docs, fm_frames="array<struct<units:long,chars:long,data:binary>>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=level)
        kind = pa.list_(pa.struct([("units", pa.int64()), ("chars", pa.int64()), ("data", pa.binary())]))
        for batch in (part for whole in batches for part in slices(whole, "fm_text")):
            frames = [frames_of(t or b"", frame, packer) for t in batch.column("fm_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(frames, kind)], [*names, "fm_frames"])

    return docs.withColumn("fm_text", F.col(text).cast("binary")).mapInArrow(run, schema)


def draws(key: Column, seed: int = 1) -> list[Column]:
    """Four unsigned 32-bit numbers of a key: the first hex digits of the SHA-256 of ``seed:key``; a NULL key is empty."""
    digits = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digits, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def arranged(rows: DataFrame, key: str = "doc_id", seed: int = 1, plain: int = PLAIN_PERCENT, spm: int = SPM_PERCENT,
             frame: int = FRAME, level: int = 3) -> DataFrame:
    """Rows of ``stored`` with ``fm_units``, ``fm_form``, ``fm_prefix_chars``, ``fm_middle_chars`` and ``fm_output``,
    the output as Zstandard frames in order, in place of ``fm_frames``.

    Two cuts are drawn per key among the units' borders, so rows with equal keys draw alike; ``plain`` percent of the
    keys, empty texts and texts that hold a mark stay as they are (counts NULL), ``spm`` percent of the others put
    the suffix first. Only frames that hold a cut are opened, besides the search for marks.
    """
    for i, draw in enumerate(draws(F.col(key), seed)):
        rows = rows.withColumn(f"fm_h{i}", draw)
    names = [c for c in rows.columns if not c.startswith("fm_")]
    kept = rows.select(*[F.col(f"`{c}`") for c in names])
    added = {"fm_units": "long", "fm_form": "string", "fm_prefix_chars": "long", "fm_middle_chars": "long",
             "fm_output": "array<binary>"}

    def one(frames: list[dict], h: list[int], packer, opener) -> tuple:
        text = Seekable(frames, opener)
        n = text.ends[-1] if frames else 0
        if n == 0 or h[2] % 100 >= 100 - plain or text.holds((PREFIX, SUFFIX, MIDDLE)):
            return n, "plain", None, None, [f["data"] for f in frames]
        form = "spm" if h[3] % 100 < spm else "psm"
        cuts = [text.cut(u) for u in sorted((h[0] % (n + 1), h[1] % (n + 1)))]
        out = list(output_frames(text, form, [c[:2] for c in cuts], frame, packer))
        return n, form, cuts[0][2], cuts[1][2] - cuts[0][2], out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, opener = zstandard.ZstdCompressor(level=level), zstandard.ZstdDecompressor()
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.binary())]
        for batch in (part for whole in batches for part in slices(whole, "fm_frames")):
            seeds = zip(*(batch.column(f"fm_h{i}").to_pylist() for i in range(4)))
            made = [one(f or [], h, packer, opener) for f, h in zip(batch.column("fm_frames").to_pylist(), seeds)]
            columns = [pa.array([m[i] for m in made], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *columns], [*names, *added])

    return rows.mapInArrow(run, widened(kept, **added))


def digested(rows: DataFrame) -> DataFrame:
    """Rows of ``arranged`` with ``fm_output_sha256`` and ``fm_restored_sha256`` in place of ``fm_output``: frames are
    opened in order, one at a time; the second digest is that of the text rebuilt from output and form."""
    names = [c for c in rows.columns if c != "fm_output"]
    kept = rows.select(*[F.col(f"`{c}`") for c in names])
    added = {"fm_output_sha256": "string", "fm_restored_sha256": "string"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opener = zstandard.ZstdDecompressor()
        for batch in (part for whole in batches for part in slices(whole, "fm_output")):
            sums = [[], []]
            for frames, form in zip(batch.column("fm_output").to_pylist(), batch.column("fm_form").to_pylist()):
                both = hashlib.sha256(), hashlib.sha256()
                for f in frames:
                    both[0].update(opener.decompress(f))
                for piece in rebuilt(frames, form, opener):
                    both[1].update(piece)
                for own, s in zip(sums, both):
                    own.append(s.hexdigest())
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *(pa.array(s, pa.string()) for s in sums)],
                                             [*names, *added])

    return rows.mapInArrow(run, widened(kept, **added))


def texts(rows: DataFrame) -> DataFrame:
    """Rows of ``arranged`` with the output as a string, ``fm_text``, in place of ``fm_output``."""
    names = [c for c in rows.columns if c != "fm_output"]
    kept = rows.select(*[F.col(f"`{c}`") for c in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opener = zstandard.ZstdDecompressor()
        for batch in (part for whole in batches for part in slices(whole, "fm_output", 1 << 20)):
            out = [b"".join(map(opener.decompress, f)) for f in batch.column("fm_output").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(out, pa.binary()).view(pa.string())],
                                             [*names, "fm_text"])

    return rows.mapInArrow(run, widened(kept, fm_text="string"))


def digest(docs: DataFrame) -> DataFrame:
    """Form, sizes and digests of every document's output."""
    rows = digested(arranged(stored(docs.select("doc_id", "text")).drop("text")))
    return rows.select("doc_id", F.col("fm_units").alias("n"), F.col("fm_form").alias("form"),
                       F.col("fm_prefix_chars").alias("prefix_chars"), F.col("fm_middle_chars").alias("middle_chars"),
                       F.col("fm_output_sha256").alias("output_sha256"), F.col("fm_restored_sha256").alias("restored_sha256"))


CHECK_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS u,
             [('0x' || substr(h, 1 + 8 * i, 8))::BIGINT for i in range(4)] AS h FROM d),
c AS (SELECT doc_id, t, u, len(u) AS n, h[1] % (len(u) + 1) AS a, h[2] % (len(u) + 1) AS b,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90
                  THEN 'plain' WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT doc_id, t, n, form, array_to_string(u[1:least(a, b)], '') AS prefix,
             array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS middle,
             array_to_string(u[greatest(a, b) + 1:], '') AS suffix FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p"""
