"""Lines that many documents share: two Bloom filters find suspects, only those are shuffled for exact counts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from . import bloom
from .common import slices, small_batches, widened, written

STRIPPED = b" \t\n\x0b\x0c\r"
MIN_CHARS, MIN_DOCS = 40, 5
#: Repeated keys that are sent to every task; beyond that documents are joined with their own keys.
SENT_KEYS = 100_000


def line_keys(text: bytes | None, min_chars: int = MIN_CHARS) -> Iterator[tuple[int, bytes]]:
    """Number and key of each line whose key has at least ``min_chars`` code points."""
    for i, line in enumerate((text or b"").split(b"\n")):
        if len(line) < min_chars:
            continue
        key = line.strip(STRIPPED).lower()  # bytes: A-Z only
        if len(key) >= min_chars and (key.isascii() or sum(b & 0xC0 != 0x80 for b in key) >= min_chars):
            yield i, key


def digest_of(key: bytes) -> bytes:
    """128 bits that stand for a key in shuffles."""
    return hashlib.blake2b(key, digest_size=16).digest()


def _suspects(texts: list, twice: bloom.Filter, min_chars: int) -> list[list[tuple[int, bytes]]]:
    """Per text the lines that the filter passes, with their digests."""
    found = [list(line_keys(t, min_chars)) for t in texts]
    h = np.fromiter((xxhash.xxh64_intdigest(k) for keys in found for _, k in keys), np.uint64)
    hit = iter(twice.hits(h).tolist())
    return [[(i, digest_of(k)) for i, k in keys if next(hit)] for keys in found]


def suspected_filter(rows: DataFrame, min_chars: int) -> Broadcast:
    """The twice-seen filter of the keys of ``ld_text``; its size follows the number of lines."""
    body = F.col("ld_text").cast("string")
    n = rows.agg(F.sum(F.length(body) - F.length(F.replace(body, F.lit("\n"))) + 1)).first()[0]

    def hashes(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for text in batch.column(0):
            yield np.fromiter((xxhash.xxh64_intdigest(k) for _, k in line_keys(text.as_py(), min_chars)), np.uint64)

    return bloom.build(rows.select("ld_text"), hashes, n or 1)


def repeated_keys(rows: DataFrame, twice: Broadcast, min_chars: int, min_docs: int) -> tuple[DataFrame, DataFrame]:
    """``(digest, doc)`` of all suspects, and ``(digest, keep)`` of keys in at least ``min_docs`` documents."""
    kind = rows.schema["ld_doc"].dataType

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "ld_text")):
            docs, keys = [], []
            for at, own in enumerate(_suspects(batch.column("ld_text").to_pylist(), twice.value, min_chars)):
                own = {d for _, d in own}
                docs += [at] * len(own)
                keys += own
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), batch.column("ld_doc").take(pa.array(docs, pa.int64()))], ["digest", "doc"])

    pairs = rows.mapInArrow(suspects, f"digest binary, doc {kind.simpleString()}").distinct()
    pairs = written(pairs, "suspects")
    found = pairs.groupBy("digest").agg(F.count("*").alias("n"), F.max("doc").alias("keep"))
    return pairs, written(found.where(F.col("n") >= min_docs).select("digest", "keep"), "repeated-lines")


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
                    min_docs: int = MIN_DOCS, sent_keys: int = SENT_KEYS) -> DataFrame:
    """``docs`` without repeated lines in ``text``, with ``ld_lines`` (before) and ``ld_dropped`` added.

    A line's key is the line without white space at its ends, A-Z lower-cased. A key of at least ``min_chars`` code
    points that ``min_docs`` or more documents hold loses all its lines, except in the document with the largest
    ``key``. Rows with equal keys count as one document, and so do all rows with a NULL key, which come last. A NULL
    text counts as one line and stays NULL. Extra columns pass through, except that those whose names begin with
    ``ld_`` are replaced. An empty table stays empty.
    """
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if not c.startswith("ld_")])
    # what the tasks need goes under own names, so that columns of docs can't clash
    slim = docs.select(F.col(key).alias("ld_doc"), F.col(text).cast("binary").alias("ld_text"))
    with small_batches(docs.sparkSession):
        twice = suspected_filter(slim, min_chars)
        pairs, repeated = repeated_keys(slim, twice, min_chars, min_docs)
    kept = repeated.limit(sent_keys + 1).toArrow()
    rows = docs.withColumns({"ld_doc": F.col(key), "ld_text": F.col(text).cast("binary")})
    if kept.num_rows <= sent_keys:
        sent = docs.sparkSession.sparkContext.broadcast(
            dict(zip(kept.column("digest").to_pylist(), kept.column("keep").to_pylist())))
    else:
        sent = None
        gone = pairs.join(repeated, "digest").where(~F.col("doc").eqNullSafe(F.col("keep")))
        gone = gone.groupBy(F.col("doc").alias("ld_key")).agg(F.collect_list("digest").alias("ld_gone"))
        rows = rows.join(gone, F.col("ld_doc").eqNullSafe(F.col("ld_key")), "left")
    names = docs.columns

    def rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "ld_text")):
            texts, ids = batch.column("ld_text").to_pylist(), batch.column("ld_doc").to_pylist()
            own = batch.column("ld_gone").to_pylist() if sent is None else None
            new, lines, dropped = [], [], []
            for at, found in enumerate(_suspects(texts, twice.value, min_chars)):
                if sent is None:
                    out = set(own[at] or ())
                    out = {i for i, d in found if d in out}
                else:
                    out = {i for i, d in found if d in sent.value and sent.value[d] != ids[at]}
                parts = (texts[at] or b"").split(b"\n")
                lines.append(len(parts))
                dropped.append(len(out))
                new.append(b"\n".join(x for i, x in enumerate(parts) if i not in out) if out else texts[at])
            columns = {n: batch.column(n) for n in names}
            columns[text] = pa.array(new, pa.binary()).view(pa.string())
            yield pa.RecordBatch.from_arrays([*columns.values(), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())],
                                             [*names, "ld_lines", "ld_dropped"])

    return rows.mapInArrow(rebuilt, widened(docs, ld_lines="long", ld_dropped="long"))


def digest(docs: DataFrame) -> DataFrame:
    rows = without_repeats(docs.select("doc_id", "text"))
    return rows.select("doc_id", F.col("ld_lines").alias("n_lines"), F.col("ld_dropped").alias("n_dropped"),
                       F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


CHECK_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
l AS (SELECT rid, doc_id, unnest(string_split(t, chr(10))) AS line, unnest(range(len(string_split(t, chr(10))))) AS i FROM d),
k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (SELECT key, max(doc_id) AS keep FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
x AS (SELECT rid, k.doc_id, i, line, r.key IS NOT NULL AND k.doc_id <> keep AS gone FROM k LEFT JOIN r ON k.key = r.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM x GROUP BY rid"""
