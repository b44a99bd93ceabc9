"""Web archives with one Zstandard frame per record and the dictionary in a leading skippable frame."""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.stores import scratch_path
from .common import written

DATE = "2020-01-01T00:00:00Z"
#: Payloads shorter than this are always written in full.
REVISIT_BYTES = 100
#: The dictionary is fitted on so many payloads, chosen by hash, of which so many bytes each.
SAMPLE_PAYLOADS, SAMPLE_BYTES, DICTIONARY_BYTES = 256, 16_384, 32_768
LEVEL = 3
#: Frame marks. An empty skippable frame stands between two records, because the text writer that puts
#: the bytes on any file system needs a separator.
DICTIONARY_MARK, SKIP_MARKS, FRAME_MARK = 0x184D2A5D, range(0x184D2A50, 0x184D2A60), 0xFD2FB528
SEPARATOR = "P*M\x18\0\0\0\0"


class BrokenArchive(ValueError):
    """A frame, header or length that doesn't fit."""


# --- records ---------------------------------------------------------------------------------------

def _safe(uri: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", uri or "about:blank")


def _urn(key: int | None) -> str:
    return f"<urn:page:{'null' if key is None else key}>"


def record(key: int | None, uri: str | None, payload: bytes, sha256: str, refers_to: int | None, revisit: bool) -> bytes:
    """A response with its payload, or a revisit that only names the record with the same payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_urn(key)}",
            f"WARC-Target-URI: {_safe(uri)}", f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha256:{sha256}"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {_urn(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(lines: bytes) -> dict[str, str]:
    found = {}
    for line in lines.decode("utf-8").split("\r\n"):
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip():
            raise BrokenArchive(f"not a header: {line[:80]!r}")
        found[name.lower()] = value.strip()
    return found


def parse(raw: bytes) -> dict:
    """A record's fields; raises ``BrokenArchive`` unless version, headers, lengths and digest hold."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    version, _, lines = head.partition(b"\r\n")
    if not gap or version != b"WARC/1.1":
        raise BrokenArchive("no version line or end of headers")
    named = _headers(lines)
    missing = {"warc-type", "warc-record-id", "warc-date", "content-length"} - named.keys()
    if missing:
        raise BrokenArchive(f"missing {sorted(missing)}")
    if not named["content-length"].isdigit() or len(rest) != int(named["content-length"]) + 4 or not rest.endswith(b"\r\n\r\n"):
        raise BrokenArchive(f"block of {len(rest) - 4} bytes, header says {named['content-length']}")
    http, gap, payload = rest[:-4].partition(b"\r\n\r\n")
    if not gap or not http.startswith(b"HTTP/"):
        raise BrokenArchive("no HTTP response in the block")
    length = _headers(http.partition(b"\r\n")[2]).get("content-length", "")
    kind, digest = named["warc-type"], named.get("warc-payload-digest", "").removeprefix("sha256:")
    if kind == "response":
        if str(len(payload)) != length:
            raise BrokenArchive(f"payload of {len(payload)} bytes, header says {length}")
        if hashlib.sha256(payload).hexdigest() != digest:
            raise BrokenArchive("the payload's digest differs")
    elif kind != "revisit" or payload or not length.isdigit() or "warc-refers-to" not in named:
        raise BrokenArchive(f"bad {kind} record")
    return {"record_id": named["warc-record-id"], "uri": named.get("warc-target-uri"), "record_type": kind,
            "refers_to": named.get("warc-refers-to"), "payload_bytes": int(length), "payload_digest": digest,
            "payload": payload if kind == "response" else None}


# --- frames ----------------------------------------------------------------------------------------

def skippable(mark: int, content: bytes) -> bytes:
    return struct.pack("<II", mark, len(content)) + content


def _frame_end(data: memoryview, at: int) -> int:
    """Where the frame that starts at ``at`` ends, by its header and block lengths."""
    try:
        end = at + zstandard.frame_header_size(data[at:at + 18])
        checked = zstandard.get_frame_parameters(data[at:at + 18]).has_checksum
        while True:
            if end + 3 > len(data):
                raise BrokenArchive("the last frame is cut off")
            block = int.from_bytes(data[end:end + 3], "little")
            end += 3 + (1 if block >> 1 & 3 == 1 else block >> 3)
            if block & 1:
                break
    except zstandard.ZstdError as bad:
        raise BrokenArchive(f"bad frame at byte {at}: {bad}") from bad
    end += 4 * checked
    if end > len(data):
        raise BrokenArchive("the last frame is cut off")
    return end


def frames(archive: bytes) -> Iterator[bytes]:
    """The decoded frames of an archive in order. A dictionary counts only in the first frame."""
    data, at = memoryview(archive), 0
    unpacker = zstandard.ZstdDecompressor()
    while at < len(data):
        if at + 8 > len(data):
            raise BrokenArchive("the last frame is cut off")
        mark, size = struct.unpack_from("<II", data, at)
        if mark in SKIP_MARKS:
            if at + 8 + size > len(data):
                raise BrokenArchive("the last frame is cut off")
            if at == 0 and mark == DICTIONARY_MARK:
                content = bytes(data[8:8 + size])
                if content[:4] == struct.pack("<I", FRAME_MARK):  # the dictionary may be packed itself
                    content = zstandard.ZstdDecompressor().decompress(content)
                unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content))
            at += 8 + size
            continue
        if mark != FRAME_MARK:
            raise BrokenArchive(f"no frame at byte {at}")
        end = _frame_end(data, at)
        try:
            yield unpacker.decompress(data[at:end])
        except zstandard.ZstdError as bad:
            raise BrokenArchive(f"bad frame at byte {at}: {bad}") from bad
        at = end


# --- tables ----------------------------------------------------------------------------------------

def fit_dictionary(pages: DataFrame, key: str = "page_id", html: str = "html") -> bytes:
    """A dictionary from a bounded sample of payloads, empty where there are too few to fit one."""
    rows = pages.where(F.col(html).isNotNull()).select(F.col(html).alias("p"), F.xxhash64(key, html).alias("h"))
    # the smallest hashes first, so that tasks send hashes to the driver and only the chosen rows' payloads
    last = rows.select("h").distinct().orderBy("h").limit(SAMPLE_PAYLOADS).agg(F.max("h")).first()[0]
    if last is None:
        return b""
    chosen = rows.where(F.col("h") <= last).select(F.substring("p", 1, SAMPLE_BYTES).cast("binary").alias("s"))
    texts = [bytes(r["s"]) for r in chosen.limit(2 * SAMPLE_PAYLOADS).collect()]
    if len(texts) < 16:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, texts).as_bytes()
    except zstandard.ZstdError:  # the samples are too short or too much alike
        return b""


def classified(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """``pages`` with ``w_payload``, ``w_digest``, ``w_revisit`` and ``w_refers_to``.

    Of rows with equal payloads of at least 100 bytes the smallest key is the response; rows with that key all are.
    NULL keys revisit; where all keys are NULL none does.
    """
    rows = pages.withColumn("w_payload", F.coalesce(F.col(html), F.lit("")).cast("binary"))
    rows = rows.withColumn("w_digest", F.sha2("w_payload", 256))
    firsts = rows.where(F.octet_length("w_payload") >= REVISIT_BYTES).groupBy(F.col("w_digest").alias("w_d")).agg(
        F.min(key).alias("w_first"), F.count("*").alias("w_n")).where("w_n > 1").drop("w_n")
    rows = rows.join(written(firsts, "payloads"), F.col("w_digest") == F.col("w_d"), "left")
    revisit = F.col("w_first").isNotNull() & ~F.col(key).eqNullSafe(F.col("w_first"))
    return rows.withColumns({"w_revisit": revisit, "w_refers_to": F.when(revisit, F.col("w_first"))}).drop("w_d", "w_first")


def write_archives(pages: DataFrame, path: str, key: str = "page_id", uri: str = "url", html: str = "html") -> None:
    """An archive per task: the dictionary, then a frame per row. Spark's text writer commits the files."""
    dictionary = pages.sparkSession.sparkContext.broadcast(fit_dictionary(pages, key, html))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        content, packer = dictionary.value, None
        for batch in batches:
            out = []
            if packer is None:
                packer = zstandard.ZstdCompressor(
                    LEVEL, zstandard.ZstdCompressionDict(content) if content else None, write_checksum=True)
                out += [skippable(DICTIONARY_MARK, content)] if content else []
            for k, u, p, d, r, v in zip(*(c.to_pylist() for c in batch.columns)):
                out.append(packer.compress(record(k, u, p, d, r, v)))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["frame"])

    rows = classified(pages, key, html).select(key, uri, "w_payload", "w_digest", "w_refers_to", "w_revisit")
    stored = rows.mapInArrow(packed, "frame binary").select(F.col("frame").cast("string").alias("frame"))
    stored.write.option("lineSep", SEPARATOR).text(path)


RECORD = ("record_id string, uri string, record_type string, refers_to string, payload_bytes long, "
          "payload_digest string, payload binary")


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records of all archives in a folder, validated; a broken one ends the job with ``BrokenArchive``.

    An archive is decoded in one task, frame by frame; its size is that of the task that wrote it.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    columns = RECORD if payload else RECORD.rpartition(",")[0]
    names = [c.split()[0] for c in columns.split(", ")]

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(n, {"payload_bytes": pa.int64(), "payload": pa.binary()}.get(n, pa.string())) for n in names])
        for batch in batches:
            for content in batch.column(0):
                held, size = [], 0
                for raw in frames(content.as_buffer()):
                    found = parse(raw)
                    held.append({n: found[n] for n in names})
                    size += len(raw) if payload else 512
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    return files.mapInArrow(decoded, columns)


def digest(pages: DataFrame) -> DataFrame:
    """Write all pages, read the archives back, and return what the records say."""
    spark = pages.sparkSession
    path = scratch_path(spark, "archives")
    write_archives(pages.select("page_id", "url", "html"), path)
    found = read_archives(spark, path, payload=False)
    key = lambda c: F.expr(f"try_cast(regexp_extract({c}, '^<urn:page:(-?[0-9]+)>$', 1) AS BIGINT)")
    return found.select(key("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                        key("refers_to").alias("refers_to"))
