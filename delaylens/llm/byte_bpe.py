"""Byte-level BPE: the tokenizers library encodes Arrow batches, bytes are written as characters and read back."""

from __future__ import annotations

import base64
import codecs
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import slices, widened

MODEL = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
#: Chunks kept with their ids in a worker, and the longest that is kept.
KEPT, KEPT_CHARS = 200_000, 48
#: What stands for an id that the vocabulary doesn't have.
UNKNOWN = "�".encode()

_SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
#: No match of PATTERN crosses the borders of these chunks: letters before a blank or a mark, other words with the
#: blank before them, white space up to that blank.
_CHUNK = re.compile(f" ?[A-Za-z]+(?=[ \n,.;:!?])| ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where it is one, else the next free one from U+0100 on."""
    plain = {b for b in range(256) if chr(b).isprintable() and not chr(b).isspace()}
    free = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(free)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks, a line of base64 and number each."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def tokenizer_json(ranks: dict[bytes, int], pattern: str = PATTERN) -> str:
    """A tokenizer with these ranks: any two tokens that make up a third merge, in the order of the third's rank."""
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    chars = byte_characters()
    written = {token: "".join(chars[b] for b in token) for token in ranks}
    merges = [(written[token[:i]], written[token[i:]]) for token in sorted(ranks, key=ranks.get)
              for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks]
    tokenizer = Tokenizer(models.BPE({written[t]: rank for t, rank in ranks.items()}, merges, ignore_merges=True))
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), "isolated"),
        pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return tokenizer.to_str()


class Encoder:
    """Ids of texts, packed as little-endian unsigned 32-bit integers; frequent chunks are looked up."""

    def __init__(self, model: str, chunked: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model)
        self.chunked = chunked
        self.known: dict[str, bytes] = {}

    def _fresh(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.chunked:
            return self._fresh(texts)
        parts, known = [_CHUNK.findall(t) for t in texts], self.known
        if len(known) > KEPT:  # the worker's memory stays bounded
            known.clear()
        missing = list({p for own in parts for p in own if p not in known})
        known.update(zip(missing, self._fresh(missing)))
        out = [b"".join([known[p] for p in own]) for own in parts]
        for long in missing:
            if len(long) > KEPT_CHARS:
                del known[long]
        return out


@lru_cache(maxsize=2)
def encoder(model: str, chunked: bool) -> Encoder:
    return Encoder(model, chunked)


@lru_cache(maxsize=2)
def token_bytes(model: str) -> list[bytes]:
    """The bytes of each id: the vocabulary's characters read back as bytes."""
    back = {c: b for b, c in enumerate(byte_characters())}
    vocabulary = json.loads(model)["model"]["vocab"]
    tokens = [UNKNOWN] * (max(vocabulary.values(), default=-1) + 1)
    for text, at in vocabulary.items():
        tokens[at] = bytes(back[c] for c in text)
    return tokens


def joined(ids: bytes, tokens: list[bytes]) -> bytes:
    """The bytes of packed ids; an unknown id is U+FFFD."""
    at = np.frombuffer(ids, "<u4")
    if len(at) and at.max() >= len(tokens):
        return b"".join(tokens[i] if i < len(tokens) else UNKNOWN for i in at.tolist())
    return b"".join([tokens[i] for i in at.tolist()])


def token_texts(ids: bytes, tokens: list[bytes]) -> list[str]:
    """The text of each token; a character split over tokens belongs to that with its last byte.

    Bytes that are no UTF-8, also at the end, become U+FFFD.
    """
    reader = codecs.getincrementaldecoder("utf-8")("replace")
    at = np.frombuffer(ids, "<u4").tolist()
    return [reader.decode(tokens[i] if i < len(tokens) else UNKNOWN, k == len(at) - 1) for k, i in enumerate(at)]


def character_spans(ids: np.ndarray, lengths: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First character, character after the last, and whether it begins inside a character, for each token."""
    last = np.cumsum(lengths[ids])
    first = last - lengths[ids]
    begins = (data & 0xC0) != 0x80
    number = np.cumsum(begins) - 1
    return number[first], number[last - 1] + 1, ~begins[first]


def _model(docs: DataFrame, path: str, pattern: str):
    # a vocabulary has a fixed size (about 2 MB), whatever the size of the table
    return docs.sparkSession.sparkContext.broadcast(tokenizer_json(read_ranks(path), pattern))


def encoded(docs: DataFrame, text: str = "text", path: str = MODEL, pattern: str = PATTERN,
            offsets: bool = False) -> DataFrame:
    """``docs`` with the ids of ``text`` added: ``bb_ids`` packed as little-endian unsigned 32-bit integers,
    ``bb_tokens`` their number, ``bb_split`` how many tokens begin inside a character; with ``offsets``, also
    ``bb_offsets``, each token's first character and the one after its last (tokens share a split character).

    Each match of ``pattern`` is encoded by itself by the ranks in ``path``, which the driver reads; special tokens
    are ordinary text. A NULL or empty text has no ids. Columns of ``docs`` whose names begin with ``bb_`` are
    replaced, all others pass through; repeated rows stay; an empty table stays empty. Chunks are looked up when the
    pattern is the default one; with another pattern whole texts are encoded.
    """
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if not c.startswith("bb_")])
    sent = _model(docs, path, pattern)
    chunked, names = pattern == PATTERN, docs.columns
    extra = {"bb_ids": "binary", "bb_tokens": "long", "bb_split": "long"}
    if offsets:
        extra["bb_offsets"] = "array<struct<first:int,last:int>>"
    schema = widened(docs, **extra)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(sent.value, chunked)
        lengths = np.array([len(t) for t in token_bytes(sent.value)], np.int64)
        for batch in (part for whole in batches for part in slices(whole, "bb_text", 2 << 20)):
            texts = [t or "" for t in batch.column("bb_text").to_pylist()]
            packed = coder.encode(texts)
            counts = np.array([len(p) // 4 for p in packed], np.int64)
            ids = np.frombuffer(b"".join(packed), "<u4")
            data = np.frombuffer("".join(texts).encode(), np.uint8)
            first, last, split = character_spans(ids, lengths, data) if len(ids) else (ids, ids, ids.astype(bool))
            ends = np.concatenate([[0], np.cumsum(counts)])
            before = np.concatenate([[0], np.cumsum(split)])
            columns = [batch.column(n) for n in names]
            columns += [pa.array(packed, pa.binary()), pa.array(counts), pa.array(before[ends[1:]] - before[ends[:-1]])]
            if offsets:
                base = np.repeat(np.concatenate([[0], np.cumsum([len(t) for t in texts])])[:-1], counts)
                spans = pa.StructArray.from_arrays([pa.array((first - base).astype(np.int32)),
                                                    pa.array((last - base).astype(np.int32))], ["first", "last"])
                columns.append(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), spans))
            yield pa.RecordBatch.from_arrays(columns, [*names, *extra])

    return docs.withColumn("bb_text", F.col(text)).mapInArrow(run, schema)


def decoded(rows: DataFrame, ids: str = "bb_ids", path: str = MODEL, pieces: bool = False) -> DataFrame:
    """``rows`` with the bytes of the packed ids added as ``bb_bytes``; with ``pieces``, also ``bb_pieces``, the text
    of each token, a split character with the token that ends it.

    NULL or no ids give no bytes; an id that the vocabulary doesn't have gives U+FFFD. Ids that end inside a
    character keep its bytes in ``bb_bytes``. Columns of ``rows`` with these two names are replaced.
    """
    rows = rows.drop("bb_bytes", "bb_pieces")
    sent = _model(rows, path, PATTERN)
    names = rows.columns
    extra = {"bb_bytes": "binary"} | ({"bb_pieces": "array<string>"} if pieces else {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = token_bytes(sent.value)
        for batch in (part for whole in batches for part in slices(whole, "bb_packed", 4 << 20)):
            packed = [p or b"" for p in batch.column("bb_packed").to_pylist()]
            columns = [batch.column(n) for n in names] + [pa.array([joined(p, tokens) for p in packed], pa.binary())]
            if pieces:
                columns.append(pa.array([token_texts(p, tokens) for p in packed], pa.list_(pa.string())))
            yield pa.RecordBatch.from_arrays(columns, [*names, *extra])

    return rows.withColumn("bb_packed", F.col(ids)).mapInArrow(run, widened(rows, **extra))


def digest(docs: DataFrame) -> DataFrame:
    """Per document the number of tokens and the digests of its ids and of the decoded bytes."""
    rows = decoded(encoded(docs.select("doc_id", "text")).drop("text"))
    return rows.select("doc_id", F.col("bb_tokens").alias("n_tokens"), F.sha2("bb_ids", 256).alias("ids_sha256"),
                       F.sha2("bb_bytes", 256).alias("decoded_sha256"), F.col("bb_split").alias("n_split"))
