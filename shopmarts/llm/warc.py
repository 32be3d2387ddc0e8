"""Web archives: WARC records in Zstandard files with a shared dictionary.

A file begins with a skippable frame that holds the dictionary; every record is a frame of its own, so
it can be read alone. The writer deals pages over tasks, each of which writes files of bounded size;
the reader takes the dictionary from a file's first frame, decodes frame by frame, and validates
the header lines, both lengths and the payload's digest.

Equal payloads of at least 1000 bytes are stored once: the record with the largest page id is a
response, the others are revisits that name it.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopmarts.llm.files import put
from shopmarts.llm.memory import tidy
from shopmarts.llm.sampling import bounded_sample
from shopmarts.llm.words import blocks

LEAST_REVISIT = 1_000
SAMPLE_PAGES = 500  # for the dictionary at most, of those with small hashes of their ids
SAMPLE_CHARS = 4_096  # of each
DICTIONARY_BYTES = 64 << 10
FILE_BYTES = 32 << 20
READ_BYTES = 4 << 10  # of an archive, in one step
HTML_BYTES = 4 << 20  # of pages taken from Arrow in one step, unless one page is longer

# Fixed values of the formats.
SKIPPABLE = 0x184D2A5D
FRAME = 0xFD2FB528
VERSION = b"WARC/1.1"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ENDING = b"\r\n\r\n"

RECORDS = (
    "page_id long, url string, payload_bytes long, payload_digest string, "
    "record_type string, refers_to long"
)


class BadArchive(ValueError):
    """An archive that is cut off, changed or no archive."""


@dataclass(frozen=True)
class Record:
    page_id: int | None
    url: str | None
    kind: str
    refers_to: int | None
    payload_bytes: int
    digest: str  # SHA-1 of the full payload, in hex
    payload: bytes | None  # a revisit has none


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_id(record_id: str) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d*)>", record_id)
    if not found:
        raise BadArchive(f"unknown record id {record_id[:80]}")
    return int(found[1]) if found[1] else None


def _quoted(url: str) -> str:
    """Header lines hold no line ends or other control characters."""
    return re.sub(r"[\x00-\x20\x7f%]", lambda m: f"%{ord(m.group()):02X}", url)


def _unquoted(url: str) -> str:
    return re.sub(r"%([0-7][0-9A-F])", lambda m: chr(int(m[1], 16)), url)


def record_bytes(record: Record, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One record, uncompressed: header lines, block, two line ends."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {record.payload_bytes}\r\n\r\n"
    ).encode()
    block = http + (record.payload or b"") if record.kind == "response" else http
    digest = base64.b32encode(bytes.fromhex(record.digest)).decode()
    lines = [
        f"WARC-Type: {record.kind}",
        f"WARC-Record-ID: {_record_id(record.page_id)}",
        f"WARC-Date: {date}",
    ]
    if record.url is not None:
        lines.append(f"WARC-Target-URI: {_quoted(record.url)}")
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if record.kind == "revisit":
        lines.append(f"WARC-Profile: {IDENTICAL}")
        lines.append(f"WARC-Refers-To: {_record_id(record.refers_to)}")
    lines.append("Content-Type: application/http; msgtype=response")
    lines.append(f"Content-Length: {len(block)}")
    return VERSION + b"\r\n" + "\r\n".join(lines).encode() + ENDING + block + ENDING


def _fields(lines: bytes) -> dict[str, str]:
    found = {}
    for line in lines.decode("utf-8").split("\r\n"):
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip():
            raise BadArchive(f"not a header line: {line[:80]!r}")
        found[name.lower()] = value.strip()
    return found


def parse_record(raw: bytes) -> Record:
    """The record, after checking version, headers, both lengths and the digest."""
    head, ending, rest = raw.partition(ENDING)
    version, _, lines = head.partition(b"\r\n")
    if version != VERSION or not ending:
        raise BadArchive("a record without a version line or the end of its headers")
    fields = _fields(lines)
    try:
        length = int(fields["content-length"])
        kind, page_id = fields["warc-type"], _page_id(fields["warc-record-id"])
        scheme, _, digest = fields["warc-payload-digest"].partition(":")
        digest = base64.b32decode(digest).hex()
    except (KeyError, ValueError) as error:
        raise BadArchive(f"a required header is missing or wrong: {error}") from error
    if kind not in ("response", "revisit") or scheme != "sha1":
        raise BadArchive(f"unknown record type or digest: {kind}, {scheme}")
    if length < 0 or len(rest) != length + len(ENDING) or rest[length:] != ENDING:
        raise BadArchive("a record's length does not fit its header")
    http, ending, payload = rest[:length].partition(ENDING)
    status, _, lines = http.partition(b"\r\n")
    if not status.startswith(b"HTTP/1.1 ") or not ending:
        raise BadArchive("a record without an HTTP message")
    try:
        payload_bytes = int(_fields(lines)["content-length"])
    except (KeyError, ValueError) as error:
        raise BadArchive("a message without its length") from error
    if kind == "revisit":
        if payload or "warc-refers-to" not in fields:
            raise BadArchive("a revisit with a payload or without a reference")
        refers_to = _page_id(fields["warc-refers-to"])
    else:
        refers_to = None
        if len(payload) != payload_bytes or hashlib.sha1(payload).hexdigest() != digest:
            raise BadArchive("a payload that does not fit its length or digest")
    url = fields.get("warc-target-uri")
    return Record(
        page_id,
        None if url is None else _unquoted(url),
        kind,
        refers_to,
        payload_bytes,
        digest,
        None if kind == "revisit" else payload,
    )


def archive_records(content: bytes) -> Iterator[Record]:
    """The records of one archive, frame by frame."""
    view = memoryview(content)
    if len(view) < 8:
        raise BadArchive("an archive without its dictionary frame")
    magic, size = struct.unpack_from("<II", view)
    if magic != SKIPPABLE or 8 + size > len(view):
        raise BadArchive("an archive without its dictionary frame")
    dictionary = bytes(view[8 : 8 + size])
    if dictionary[:4] == struct.pack("<I", FRAME):  # the dictionary may itself be compressed
        dictionary = zstandard.ZstdDecompressor().decompress(dictionary)
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    decoder = zstandard.ZstdDecompressor(dict_data=shared)
    rest = view[8 + size :]
    while len(rest):
        if len(rest) < 4 or struct.unpack_from("<I", rest)[0] != FRAME:
            raise BadArchive("something other than a frame follows a record")
        # What follows a frame is copied by the library, so it gets a little more than the frame.
        one, parts, read = decoder.decompressobj(), [], 0
        while not one.eof and read < len(rest):
            some = rest[read : read + READ_BYTES]
            try:
                parts.append(one.decompress(some))
            except zstandard.ZstdError as error:
                raise BadArchive(f"a frame that cannot be decoded: {error}") from error
            read += len(some)
        if not one.eof:
            raise BadArchive("an archive is cut off in a frame")
        yield parse_record(b"".join(parts))
        rest = rest[read - len(one.unused_data) :]


def trained_dictionary(pages: DataFrame) -> bytes:
    """A dictionary from the beginnings of a bounded sample of pages; empty if they are too few."""
    some = pages.where("html <> ''").select("page_id", F.substring("html", 1, SAMPLE_CHARS).alias("html"))
    sample = bounded_sample(some, "page_id", SAMPLE_PAGES).collect()
    texts = sorted(row["html"].encode() for row in sample)
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, texts).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def write_archives(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record per page of ``pages(page_id, url, html)``; return one row per file.

    A null html is an empty payload, a null url has no target. Rows with the largest page id of their
    payload are responses, also when that id is repeated. Pages without an id become records without
    one, which no revisit names. Other columns are not read; a table without rows makes no file.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    keyed = pages.select(
        "page_id", F.octet_length(payload).alias("bytes"), F.sha1(payload).alias("digest"),
        F.xxhash64(payload).alias("hash"),
    ).where(F.col("bytes") >= LEAST_REVISIT)
    # Equal SHA-1, length and second hash are taken for equal payloads.
    same = ["digest", "bytes", "hash"]
    largest = (
        keyed.groupBy(same)
        .agg(F.max("page_id").alias("largest"), F.count("*").alias("rows"))
        .where("rows > 1")
    )
    revisits = (
        keyed.join(largest, same)
        .where("page_id < largest")
        .groupBy("page_id", "digest")
        .agg(F.max("largest").alias("refers_to"))
    )
    dictionary = trained_dictionary(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        coder = zstandard.ZstdCompressor(level=3, dict_data=shared, write_checksum=True)
        begin = struct.pack("<II", SKIPPABLE, len(dictionary)) + dictionary
        part = TaskContext.get().partitionId()
        frames = [begin]
        held = files = records = 0

        def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
            for batch in batches:
                for at, texts in blocks(batch.column(2), HTML_BYTES):
                    some = batch.slice(at, len(texts))
                    yield from zip(*(column.to_pylist() for column in some.columns), strict=True)

        def close() -> pa.RecordBatch:
            nonlocal frames, held, files, records
            put(f"{folder}/pages-{part:07d}-{files:07d}.warc.zst", b"".join(frames))
            row = {"part": part, "file": files, "n_records": records, "n_bytes": held + len(begin)}
            frames, held, records, files = [begin], 0, 0, files + 1
            return pa.RecordBatch.from_pylist([row])

        for page_id, url, html, digest, refers_to in rows_of(batches):
            body = (html or "").encode()
            kind = "response" if refers_to is None else "revisit"
            record = Record(page_id, url, kind, refers_to, len(body), digest, body)
            frames.append(coder.compress(record_bytes(record)))
            held += len(frames[-1])
            records += 1
            if held >= file_bytes:
                yield close()
        if records:
            yield close()

    placed = (
        pages.select("page_id", "url", "html", F.sha1(payload).alias("digest"))
        .join(revisits, ["page_id", "digest"], "left")
        .select("page_id", "url", "html", "digest", "refers_to")
        .sortWithinPartitions("page_id", "digest", "url")
    )
    manifest = f"{folder}/manifest"
    rows = placed.mapInArrow(tidy(run), "part long, file long, n_records long, n_bytes long")
    rows.write.mode("overwrite").parquet(manifest)
    return pages.sparkSession.read.parquet(manifest)


def read_archives(spark: SparkSession, folder: str, payloads: bool = False) -> DataFrame:
    """One row per record of the archives below ``folder``; on request with the responses' payloads."""
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    if payloads:
        names, kinds = [*names, "payload"], [*kinds, pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for x in archive_records(content.as_buffer()):
                    row = (x.page_id, x.url, x.payload_bytes, x.digest, x.kind, x.refers_to)
                    rows.append((*row, x.payload) if payloads else row)
                    held += x.payload_bytes if payloads else 0
                    if len(rows) >= 10_000 or held > 16 << 20:
                        yield _batch(rows, names, kinds)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows, names, kinds)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    schema = RECORDS + ", payload binary" if payloads else RECORDS
    return files.select("content").mapInArrow(tidy(run), schema)


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    arrays = [pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)]
    return pa.record_batch(arrays, names=names)
