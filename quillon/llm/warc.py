"""WARC archives compressed with Zstandard: writer and reader.

An archive is a sequence of frames.  The first is a skippable frame (magic 0x184D2A5D) that
holds a dictionary; then each record is one frame, compressed with that dictionary.  The reader
loads the dictionary, decodes one frame per record, and validates the version line, the
required headers, Content-Length, the closing line breaks, the HTTP block's length and the
payload digest.

Archives are rows ``(path, content)``, the shape of Spark's ``binaryFile`` source, so
``read_records`` reads archives of other origin too.  Payloads that several records share are
stored once: the record with the largest id is the response, the others revisit it.  With a
minimum length, shorter payloads are all stored as responses.  A null payload is empty.  Rows
that repeat the largest id with the same payload are responses as well.  A null id is kept
as null and comes below all others.  Line breaks in a url are written as %0D and %0A.  Long payloads are
one record like others (an archive holds one record at least); extra columns are ignored; an empty table
gives no archive.

``checked_revisits`` holds the digests of revisits against those of the records they refer to.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_bytes, salted_left_join, slices, table, written

SKIPPABLE = 0x184D2A5D
ZSTD_MAGIC = 0xFD2FB528
DICTIONARY_BYTES = 16 << 10
#: Records from which an archive's dictionary is trained, and bytes of each.
TRAIN_RECORDS, TRAIN_BYTES = 128, 4 << 10
#: An archive is closed once it holds so many bytes of payload.
ARCHIVE_BYTES = 8 << 20
#: Bytes that the reader feeds at a time.
STEP = 16 << 10
_DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class WarcError(ValueError):
    """An archive that is damaged or not in the expected form."""


class Record(NamedTuple):
    headers: dict[str, str]
    http: dict[str, str]
    payload: bytes


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _uri(page: int | None) -> str:
    return f"<urn:x-page:{'' if page is None else page}>"


def _page(uri: str) -> int | None:
    body = uri.removeprefix("<urn:x-page:").removesuffix(">")
    return int(body) if body else None


def _clean(value: str) -> str:
    """A header value without line breaks."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record_bytes(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_uri(page)}", f"WARC-Date: {_DATE}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_clean(url)}")
    if revisit:
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_uri(refers_to)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A trained dictionary, or no bytes where there is too little to train from."""
    pick = [s[:TRAIN_BYTES] for s in samples[:: max(1, len(samples) // TRAIN_RECORDS)] if s][:TRAIN_RECORDS]
    if sum(map(len, pick)) < 8 * size or len(pick) < 8:
        return b""
    try:
        return zstandard.train_dictionary(size, pick, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b""


def pack_archive(records: list[bytes], dictionary: bytes, level: int = 3) -> bytes:
    known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    compressor = zstandard.ZstdCompressor(level=level, dict_data=known, write_content_size=True, write_checksum=True)
    head = SKIPPABLE.to_bytes(4, "little") + len(dictionary).to_bytes(4, "little") + dictionary
    return head + b"".join(map(compressor.compress, records))


def parse_record(raw: bytes) -> Record:
    """Validate one decompressed record."""
    head, found, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "strict").split("\r\n")
    if not found or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise WarcError("no WARC version line")
    headers = _header_map(lines[1:])
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise WarcError(f"no {name}")
    if not headers["content-length"].isdigit():
        raise WarcError("bad content-length")
    length = int(headers["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise WarcError("record length differs from its content-length")
    block, http, payload = rest[:length], {}, rest[:length]
    if headers.get("content-type", "").startswith("application/http"):
        top, found, payload = block.partition(b"\r\n\r\n")
        if not found or not top.startswith(b"HTTP/"):
            raise WarcError("no HTTP header")
        http = _header_map(top.decode("latin-1").split("\r\n")[1:])
    if headers["warc-type"] == "response":
        if "content-length" in http and http["content-length"] != str(len(payload)):
            raise WarcError("payload length differs from its HTTP content-length")
        if (d := headers.get("warc-payload-digest")) and d.startswith("sha1:") and d[5:] != digest_of(payload):
            raise WarcError("payload digest differs")
    return Record(headers, http, payload)


def _header_map(lines: list[str]) -> dict[str, str]:
    out = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon:
            raise WarcError("header line without a colon")
        out[name.strip().lower()] = value.strip()
    return out


def read_archive(content: bytes) -> Iterator[Record]:
    """The records of one archive, one frame each."""
    at, known, first = 0, None, True
    decoder = zstandard.ZstdDecompressor()
    while at < len(content):
        if len(content) - at < 8:
            raise WarcError("archive is cut short")
        magic = int.from_bytes(content[at : at + 4], "little")
        if 0x184D2A50 <= magic <= 0x184D2A5F:
            size = int.from_bytes(content[at + 4 : at + 8], "little")
            if at + 8 + size > len(content):
                raise WarcError("dictionary frame is cut short")
            if first and magic == SKIPPABLE and size:
                body = content[at + 8 : at + 8 + size]
                if body[:4] == ZSTD_MAGIC.to_bytes(4, "little"):
                    body = zstandard.ZstdDecompressor().decompress(body, max_output_size=64 << 20)
                known = zstandard.ZstdCompressionDict(body)
                decoder = zstandard.ZstdDecompressor(dict_data=known)
            at, first = at + 8 + size, False
            continue
        first = False
        if magic != ZSTD_MAGIC:
            raise WarcError("not a Zstandard frame")
        # The frame's end is found by feeding steps, so no record copies the rest of the archive.
        stream, parts, view = decoder.decompressobj(), [], memoryview(content)
        while not stream.eof:
            if at >= len(content):
                raise WarcError("frame is cut short")
            try:
                parts.append(stream.decompress(view[at : at + STEP]))
            except zstandard.ZstdError as e:
                raise WarcError(str(e)) from e
            at = min(at + STEP, len(content))
        at -= len(stream.unused_data)
        yield parse_record(b"".join(parts))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part, count = TaskContext.get().partitionId(), 0
    rows, held = [], 0

    def close() -> pa.RecordBatch:
        dictionary = train_dictionary([r[2] for r in rows if not r[4]])
        body = pack_archive([record_bytes(p, u, x, digest_of(x), to, again) for p, u, x, to, again in rows], dictionary)
        return pa.RecordBatch.from_arrays([pa.array([f"part-{part:05d}-{count:05d}.warc.zst"]), pa.array([body], pa.binary())], names=["path", "content"])

    for batch in slices(batches):
        for page, url, payload, to, again in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), as_bytes(batch.column(2)), batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
            rows.append((page, url, payload or b"", to, again))
            held += len(rows[-1][2]) + 256
            if held >= ARCHIVE_BYTES:
                yield close()
                rows, held, count = [], 0, count + 1
    if rows:
        yield close()


def write_archives(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Archives ``(path, content)`` of ``pages`` (page_id, url, html), revisits in place of repeated payloads."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("sha", F.sha1(F.encode("html", "UTF-8")))
    # Only payloads that occur more than once are joined back.
    size = F.octet_length("html")
    least = -(1 << 63)
    shared = rows.where(size >= min_bytes).groupBy("sha").agg(F.max(F.coalesce("page_id", F.lit(least))).alias("top"), F.count("*").alias("n")).where("n > 1").select("sha", "top")
    marked = salted_left_join(rows, written(shared, "shared"), ["sha"], 96)
    again = F.coalesce((size >= min_bytes) & (F.col("top") != F.coalesce("page_id", F.lit(least))), F.lit(False))
    return marked.select("page_id", "url", "html", F.when(again, F.col("top")).alias("refers_to"), again.alias("again")).mapInArrow(_pack, "path string, content binary")


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["path", "page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    for batch in slices(batches, 1):
        path = batch.column(0).to_pylist()[0]
        out: list[tuple] = []
        held = 0

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

        for r in read_archive(batch.column(1).to_pylist()[0] or b""):
            kind = r.headers["warc-type"]
            again = kind == "revisit"
            to = r.headers.get("warc-refers-to", "")
            own = r.headers["warc-record-id"]
            size = int(r.http["content-length"]) if again and "content-length" in r.http else len(r.payload)
            out.append((path, _page(own) if own.startswith("<urn:x-page:") else None, r.headers.get("warc-target-uri"), size, r.headers.get("warc-payload-digest", "").removeprefix("sha1:"), kind, _page(to) if to.startswith("<urn:x-page:") else None, None if again else r.payload))
            held += len(r.payload)
            if held > 4 << 20:
                yield close()
                out, held = [], 0
        if out:
            yield close()


def read_records(archives: DataFrame) -> DataFrame:
    """The records of archives ``(path, content)``; the payload of a revisit is null."""
    return archives.select("path", "content").mapInArrow(_unpack, "path string, page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def checked_revisits(records: DataFrame) -> DataFrame:
    """Revisits ``(page_id, refers_to, payload_digest)`` that no response of the same digest answers for."""
    answers = records.where("record_type = 'response'").select(F.col("page_id").alias("refers_to"), "payload_digest").distinct()
    asked = records.where("record_type = 'revisit'").select("page_id", "refers_to", "payload_digest")
    return asked.alias("q").join(answers.alias("a"), F.col("q.refers_to").eqNullSafe(F.col("a.refers_to")) & (F.col("q.payload_digest") == F.col("a.payload_digest")), "left_anti")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive every page, then read the written archives back."""
    archives = written(write_archives(table(spark, sf_dir, "pages")), "warc")
    return read_records(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


__all__ = ["Record", "WarcError", "checked_revisits", "op2_warc", "pack_archive", "parse_record", "read_archive", "read_records", "record_bytes", "train_dictionary", "write_archives"]
