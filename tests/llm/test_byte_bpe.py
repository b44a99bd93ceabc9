"""Byte-level BPE against the tiktoken library, exact round trips, odd rows."""

import hashlib

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from conftest import SMALL
from delaylens.llm import byte_bpe
from delaylens.llm.queries import QUERIES


@pytest.fixture(scope="module")
def plain():
    ranks = byte_bpe.read_ranks(byte_bpe.MODEL)
    return tiktoken.Encoding("own", pat_str=byte_bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def model():
    return byte_bpe.tokenizer_json(byte_bpe.read_ranks(byte_bpe.MODEL))


def packed(ids):
    return np.array(ids, "<u4").tobytes()


def test_query_equals_tiktoken(spark, plain):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = QUERIES["op13_byte_bpe"](spark, SMALL).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        ids = plain.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(packed(ids)).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_every_character_between_others(plain, model):
    coder = byte_bpe.Encoder(model)
    every = [*range(0x3100), *range(0x3100, 0xD800, 31), *range(0xE000, 0x20000, 7), *range(0x20000, 0x110000, 997)]
    for first in range(0, len(every), 5000):
        texts = [f"a{c}1{c} {c}{c} ,{c}'s{c}  {c}" for c in map(chr, every[first:first + 5000])]
        assert coder.encode(texts) == [packed(i) for i in plain.encode_ordinary_batch(texts)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([" ", "  ", "\n", "\t", "\r\n", "a", "The", "ing", "'s", "'ll", "'", ",", ".", "!", "é", "の",
                                 "12", "　", "\xa0", "\x1c", "́", "<|endoftext|>", "\U0001f600", "_", "'S"])))
def test_mixed_pieces(plain, model, parts):
    text = "".join(parts)
    ids = packed(plain.encode_ordinary(text))
    assert byte_bpe.encoder(model, True).encode([text]) == [ids] == byte_bpe.encoder(model, False).encode([text])


def test_worker_memory_is_bounded(model, monkeypatch, plain):
    monkeypatch.setattr(byte_bpe, "KEPT", 50)
    coder = byte_bpe.Encoder(model)
    texts = [f" w{i} x{i * 7}" for i in range(400)] + ["y" * 5000]
    for first in range(0, len(texts), 20):
        part = texts[first:first + 20]
        assert coder.encode(part) == [packed(plain.encode_ordinary(t)) for t in part]
        assert len(coder.known) <= 50 + 40 and max(map(len, coder.known), default=0) <= byte_bpe.KEPT_CHARS


def test_odd_rows(spark, plain):
    texts = [None, "", "é\U0001f600の ok", "word " * 40_000 + "z" * 20_000, "same", "same"]
    rows = [(i if i else None, t, "kept", b"old", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, bb_ids binary, bb_tokens int")
    found = byte_bpe.decoded(byte_bpe.encoded(docs, offsets=True), pieces=True)
    assert found.columns == ["doc_id", "text", "ids", "bb_ids", "bb_tokens", "bb_split", "bb_offsets", "bb_bytes", "bb_pieces"]
    got = found.collect()
    assert len(got) == len(texts) and all(r.ids == "kept" for r in got)
    for r in got:
        text = r.text or ""
        assert bytes(r.bb_ids) == packed(plain.encode_ordinary(text)) and bytes(r.bb_bytes).decode() == text
        assert "".join(r.bb_pieces) == text and len(r.bb_offsets) == r.bb_tokens
        ids, split = plain.encode_ordinary(text), 0
        _, starts = plain.decode_with_offsets(ids)
        if len(text) < 100:
            whole = text.encode()
            at = [len(whole[:sum(len(plain.decode_single_token_bytes(t)) for t in ids[:k])].decode(errors="ignore"))
                  for k in range(len(ids))]
            split = sum(len(whole) and whole[sum(len(plain.decode_single_token_bytes(t)) for t in ids[:k])] & 0xC0 == 0x80
                        for k in range(len(ids)))
            assert [o.first for o in r.bb_offsets] == at and r.bb_split == split
    assert byte_bpe.decoded(byte_bpe.encoded(docs.limit(0))).isEmpty()


def test_ids_that_end_inside_a_character_or_are_unknown(spark, plain):
    smile = plain.encode_ordinary("\U0001f600")
    assert len(smile) > 1
    rows = spark.createDataFrame([(1, packed(smile[:1])), (2, packed([999_999])), (3, None)], "k int, bb_ids binary")
    got = {r.k: r for r in byte_bpe.decoded(rows, pieces=True).collect()}
    assert bytes(got[1].bb_bytes) == "\U0001f600".encode()[:len(got[1].bb_bytes)] and got[1].bb_pieces == ["�"]
    assert bytes(got[2].bb_bytes) == byte_bpe.UNKNOWN and bytes(got[3].bb_bytes) == b"" and got[3].bb_pieces == []


def test_another_pattern_and_vocabulary(spark, tmp_path):
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"bc": 257, b"abc": 258, b" a": 259}
    path = tmp_path / "own.tiktoken"
    import base64
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % r for t, r in ranks.items()))
    enc = tiktoken.Encoding("own", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
    texts = ["abc bcab", " abc", "xabcbc  a"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    for r in byte_bpe.encoded(docs, path=str(path), pattern=r"\S+|\s+").collect():
        assert bytes(r.bb_ids) == packed(enc.encode_ordinary(r.text))
