"""Hashed word n-gram logistic regression, trained with follow-the-regularised-leader updates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F

from .common import widened
from .textbytes import chunks, mix64, ngram_hashes, word_hashes, words

BITS = 18
#: Most labelled rows used for training; chosen by hash, not by place.
SAMPLE_ROWS = 20_000
#: Parts trained side by side from one state; fixed, so that the cluster's size doesn't change the model.
PARTS = 6
ROUNDS = 5
ALPHA, BETA, L1, L2 = 20.0, 1.0, 0.0, 0.01

_KIND = np.full(256, 3, np.uint64)  # other signs
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:] = 0, 1, 2, 4
for _i, _c in enumerate(b".,;:!?-\"'()#*$%&|<>_@/"):
    _KIND[_c] = 5 + _i


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of some texts, as ``(kinds, words)`` numbers, and each word's text.

    The n-grams are those of the words (one and two words) and of their shapes (one to three words): first and
    last sign, length, whether the word repeats the one before. An n-gram that would reach into the text before is
    replaced by a mark of the text's start.
    """
    s, e, doc = words(data, offsets)
    h = word_hashes(data, s, e)
    if not len(s):
        return np.zeros((5, 0), np.int64), doc
    length = np.minimum(np.ceil(np.log2(e - s + 1)), 6).astype(np.uint64)
    first = np.zeros(len(s), bool)
    first[0] = True
    first[1:] = doc[1:] != doc[:-1]
    same = np.zeros(len(s), np.uint64)
    same[1:] = (h[1:] == h[:-1]) & ~first[1:]
    middle = _KIND[data[np.minimum(s + 1, e - 1)]]
    shape = mix64(((_KIND[data[s]] * np.uint64(32) + _KIND[data[e - 1]]) * np.uint64(32) + middle) * np.uint64(16)
                  + length * np.uint64(2) + same)
    second = first.copy()
    second[1:] |= first[:-1]
    rows = []
    for kind, (base, n, edge) in enumerate(((h, 1, None), (h, 2, first), (shape, 1, None), (shape, 2, first), (shape, 3, second))):
        grams = np.full(len(h), np.uint64(11), np.uint64)
        grams[n - 1:] = ngram_hashes(base, n)
        if edge is not None:
            grams[edge] = np.uint64(11)
        rows.append(mix64(grams + np.uint64(kind + 1)) >> np.uint64(64 - BITS))
    return np.stack(rows).astype(np.int64), doc


def margins(weights: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The sparse dot product of each text: features count by their share among the text's words."""
    found, doc = features(data, offsets)
    n = len(offsets) - 1
    total = np.bincount(doc, weights[found].sum(axis=0, dtype=np.float64), n)
    return total / np.maximum(np.bincount(doc, minlength=n), 1) + weights[-1]


def probability(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def leader(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Weights in closed form from the summed adjusted gradients and squared gradients."""
    w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
    return np.where(np.abs(z) <= L1, 0.0, w)


def follow(texts: pa.Array, labels: np.ndarray, z: np.ndarray, n: np.ndarray) -> None:
    """One pass of per-coordinate updates over the texts, in place."""
    for lo, hi, data, offsets in chunks(texts):
        found, doc = features(data, offsets)
        ends = np.searchsorted(doc, np.arange(hi - lo + 1))
        for i in range(hi - lo):
            own, times = np.unique(found[:, ends[i]:ends[i + 1]], return_counts=True)
            own = np.append(own, 1 << BITS)
            x = np.append(times / max(1, ends[i + 1] - ends[i]), 1.0)
            w = leader(z[own], n[own])
            g = (probability(float(w @ x)) - labels[lo + i]) * x
            sigma = (np.sqrt(n[own] + g * g) - np.sqrt(n[own])) / ALPHA
            z[own] += g - sigma * w
            n[own] += g * g


def in_test(key: Column) -> Column:
    """Whether a row is held out: its key's CRC-32 as text is divisible by 5. A NULL key is held out."""
    return F.coalesce(F.crc32(key.cast("string")), F.lit(0)) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
          sample_rows: int = SAMPLE_ROWS, rounds: int = ROUNDS) -> np.ndarray:
    """Weights (the last is the bias) from labelled rows that are not held out.

    At most about ``sample_rows`` labelled rows are used, chosen by a hash of the key. NULL labels or keys are left
    out; of several labels of a key the smallest counts. Each round starts ``PARTS`` passes from the same state and
    averages what they add to it, so the model depends on the rows alone. Without rows all weights are 0.
    """
    known = labels.select(F.col(key).alias("k"), F.col(label).alias("y")).dropna().where(~in_test(F.col("k")))
    known = known.groupBy("k").agg(F.min("y").alias("y")).withColumn("h", F.pmod(F.xxhash64("k"), F.lit(1 << 30)))
    rows = known.count()
    known = known.where(F.col("h") < int(min(1.0, sample_rows / max(rows, 1)) * (1 << 30)))
    sample = docs.select(F.col(key).alias("k"), F.col(text).alias("text")).join(F.broadcast(known), "k")
    sample = sample.select((F.col("h") % PARTS).cast("int").alias("part"), "h", "y", "text")
    sample = sample.repartition(PARTS, "part").sortWithinPartitions("part", "h", "text").persist(StorageLevel.MEMORY_AND_DISK)
    size = (1 << BITS) + 1
    z, n = np.zeros(size), np.zeros(size)
    for _ in range(rounds):
        state = docs.sparkSession.sparkContext.broadcast((z, n))

        def passed(batches: Iterator[pa.RecordBatch], state=state) -> Iterator[pa.RecordBatch]:
            current, own = None, None
            for batch in batches:
                parts = batch.column("part").to_numpy()
                cuts = [0, *(np.flatnonzero(parts[1:] != parts[:-1]) + 1), len(parts)]
                for lo, hi in zip(cuts[:-1], cuts[1:]):
                    if lo == hi:
                        continue
                    if parts[lo] != current:
                        if own is not None:
                            yield _delta(own, state.value)
                        current, own = parts[lo], tuple(a.copy() for a in state.value)
                    follow(batch.column("text").slice(lo, hi - lo), batch.column("y").to_numpy()[lo:hi], *own)
            if own is not None:
                yield _delta(own, state.value)

        found = sample.mapInArrow(passed, "dz binary, dn binary").collect()  # PARTS rows of fixed size
        for r in found:
            z += np.frombuffer(r["dz"], np.float32).astype(float) / len(found)
            n += np.frombuffer(r["dn"], np.float32).astype(float) / len(found)
        state.unpersist()
    sample.unpersist()
    return leader(z, n).astype(np.float32)


def _delta(own, start) -> pa.RecordBatch:
    dz, dn = ((a - b).astype(np.float32).tobytes() for a, b in zip(own, start))
    return pa.RecordBatch.from_arrays([pa.array([dz]), pa.array([dn])], ["dz", "dn"])


def score(docs: DataFrame, weights: np.ndarray, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 in ``out``, in place of a column of that name. A NULL or empty text
    gets the bias alone; repeated rows score alike, an empty table stays empty."""
    docs = docs.drop(out)
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.zeros(batch.num_rows)
            for lo, hi, data, offsets in chunks(batch.column(text)):
                found[lo:hi] = probability(margins(sent.value, data, offsets))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], [*batch.schema.names, out])

    return docs.mapInArrow(scored, widened(docs, **{out: "double"}))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", "text")
    weights = train(docs, labels)
    rows = score(docs, weights).drop("text")
    return rows.select("doc_id", in_test(F.col("doc_id")).alias("held_out"), "score",
                       (F.col("score") >= 0.3).cast("int").alias("predicted"))
