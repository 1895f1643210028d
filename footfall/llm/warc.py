"""WARC archives compressed with Zstandard and a shared dictionary: writer and reader.

A file starts with a skippable frame that holds the dictionary (itself compressed), then has one frame per record.
The reader loads the dictionary, decodes one frame at a time and validates version, headers, lengths and digests;
a damaged file raises ValueError with the path and the place, nothing is skipped.

Defined results: a null or empty payload is a record of length 0; payloads below `revisit_bytes` are always stored;
of larger equal payloads the one with the largest page_id is stored and the others are revisits of it (rows that
repeat that page_id are stored again); an empty table gives no archive. Writers name files by attempt and only the
files of finished tasks are listed, so a lost executor leaves no half archive behind that is read.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.shared import shared_folder, stored

#: Fixed values of the formats.
SKIPPABLE_MAGIC = 0x184D2A5D
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = {"warc-type", "warc-record-id", "warc-date", "content-length"}

REVISIT_BYTES = 1000
DATE = "2024-01-01T00:00:00Z"
#: The dictionary is trained on the start of a bounded number of payloads.
SAMPLES, SAMPLE_CHARS, DICTIONARY_BYTES = 200, 4096, 1 << 14
ARCHIVE_BYTES = 1 << 26
LEVEL = 3
READ_BYTES = 1 << 20

RECORDS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def train_dictionary(pages: DataFrame, key: str = "page_id", html: str = "html") -> bytes:
    """A dictionary from the SAMPLES payloads whose id and length hash lowest; a plain header when they are too few."""
    rows = pages.select(F.substring(html, 1, SAMPLE_CHARS).alias("head"), F.xxhash64(key, F.length(html)).alias("h")).filter("head != ''")
    samples = [r["head"].encode() for r in rows.orderBy("h", "head").limit(SAMPLES).collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[: DICTIONARY_BYTES - 256] + _http_header(0) + VERSION


def _http_header(size: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()


def _plain(value: str) -> str:
    """A header value without line breaks or other control characters."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(name: str) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?\d*)>", name)
    if not m:
        raise ValueError(f"unknown record id {name!r}")
    return int(m[1]) if m[1] else None


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record: a response with the payload, or a revisit with the HTTP header only."""
    revisit = refers_to is not None
    block = _http_header(len(payload)) + (b"" if revisit else payload)
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _name(page_id)),
        ("WARC-Date", DATE),
        *([("WARC-Target-URI", _plain(url))] if url else []),
        ("WARC-Payload-Digest", "sha1:" + hashlib.sha1(payload).hexdigest()),
        *([("WARC-Profile", SAME_PAYLOAD), ("WARC-Refers-To", _name(refers_to))] if revisit else []),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    return VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes, place: str) -> tuple:
    """(page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload) of a validated record."""

    def need(good: bool, what: str) -> None:
        if not good:
            raise ValueError(f"{place}: {what}")

    header, found, rest = data.partition(b"\r\n\r\n")
    need(bool(found), "no end of the header")
    first, *lines = header.split(b"\r\n")
    need(first == VERSION, "unknown version")
    fields: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.decode().partition(":")
        need(bool(colon) and name == name.strip() != "", "malformed header line")
        need(name.lower() not in fields, f"repeated header {name}")
        fields[name.lower()] = value.strip()
    need(fields.keys() >= REQUIRED, "missing header")
    need(fields["content-length"].isdigit(), "malformed length")
    size = int(fields["content-length"])
    need(len(rest) == size + 4 and rest.endswith(b"\r\n\r\n"), "length does not match")
    http, found, payload = rest[:size].partition(b"\r\n\r\n")
    need(bool(found) and http.startswith(b"HTTP/"), "no HTTP header")
    length = re.search(rb"(?im)^content-length: *(\d+)\r?$", http)
    need(length is not None, "no HTTP length")
    kind, digest = fields["warc-type"], fields.get("warc-payload-digest", "")
    need(kind in ("response", "revisit") and digest.startswith("sha1:"), "unknown type or digest")
    if kind == "response":
        need(int(length[1]) == len(payload), "HTTP length does not match")
        need(hashlib.sha1(payload).hexdigest() == digest[5:], "digest does not match")
    else:
        need(not payload and "warc-refers-to" in fields, "malformed revisit")
    refers = _page(fields["warc-refers-to"]) if kind == "revisit" else None
    return _page(fields["warc-record-id"]), fields.get("warc-target-uri"), kind, refers, int(length[1]), digest[5:], payload


@lru_cache(maxsize=4)
def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict:
    return zstandard.ZstdCompressionDict(data)


def dictionary_frame(dictionary: bytes) -> bytes:
    packed = zstandard.ZstdCompressor(level=19).compress(dictionary)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(packed)) + packed


def read_archive(stream, path: str) -> Iterator[tuple]:
    """The records of an open file, one frame at a time."""
    head = stream.read(8)
    if len(head) < 8:
        raise ValueError(f"{path}: no dictionary frame")
    magic, size = struct.unpack("<II", head)
    dictionary = stream.read(size) if magic == SKIPPABLE_MAGIC else b""
    if magic != SKIPPABLE_MAGIC or len(dictionary) != size:
        raise ValueError(f"{path}: no dictionary frame")
    if dictionary.startswith(FRAME_MAGIC):
        dictionary = zstandard.ZstdDecompressor().decompress(dictionary)
    decoder = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))
    number, waiting = 0, stream.read(READ_BYTES)
    while waiting:
        frame, parts = decoder.decompressobj(), []
        while not frame.eof:
            if not waiting:
                raise ValueError(f"{path}, record {number}: truncated frame")
            try:
                parts.append(frame.decompress(waiting))
            except zstandard.ZstdError as broken:
                raise ValueError(f"{path}, record {number}: {broken}") from broken
            waiting = b"" if frame.eof else stream.read(READ_BYTES)
        yield parse_record(b"".join(parts), f"{path}, record {number}")
        number += 1
        waiting = frame.unused_data or stream.read(READ_BYTES)


def mark_revisits(pages: DataFrame, key: str = "page_id", html: str = "html", revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """`pages` with refers_to: for a payload that a page of a larger id also has, the largest such id."""
    payload = F.coalesce(F.col(html), F.lit(""))
    large = F.octet_length(payload) >= revisit_bytes
    signed = pages.withColumn("digest_", F.when(large, F.sha2(payload.cast("binary"), 256)))
    groups = (
        signed.filter("digest_ is not null").groupBy("digest_").agg(F.max(key).alias("last_"), F.count("*").alias("n_")).filter("n_ > 1")
    )
    joined = signed.join(groups.select(F.col("digest_").alias("same_"), "last_"), F.col("digest_") == F.col("same_"), "left")
    refers = F.when(F.col("last_").isNotNull() & ~F.col(key).eqNullSafe(F.col("last_")), F.col("last_"))
    return joined.withColumn("refers_to", refers).drop("digest_", "same_", "last_")


def write_archives(pages: DataFrame, folder: str, dictionary: bytes, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Writes a record for each row of `pages` (with refers_to); returns the finished files: path, records, bytes."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(folder)
        frames = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(dictionary), write_checksum=True)
        task = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        done: list[tuple[str, int, int]] = []
        stream, path, records, size = None, "", 0, 0
        for batch in batches:
            columns = [batch.column(i) for i in range(4)]
            for i in range(batch.num_rows):
                if stream is None:
                    path, records = f"{root}/{task}-{len(done):04d}.warc.zst", 0
                    stream = system.open_output_stream(path, compression=None)
                    size = stream.write(dictionary_frame(dictionary))
                page_id, target, text, refers = (c[i].as_py() for c in columns)
                size += stream.write(frames.compress(record_bytes(page_id, target, (text or "").encode(), refers)))
                records += 1
                if size >= ARCHIVE_BYTES:
                    stream.close()
                    done.append((path, records, size))
                    stream = None
        if stream is not None:
            stream.close()
            done.append((path, records, size))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=["path", "records", "bytes"])

    system, root = fs.FileSystem.from_uri(folder)
    system.create_dir(root, recursive=True)
    rows = pages.select(F.col(key).cast("long"), F.col(url).cast("string"), F.col(html).cast("string"), F.col("refers_to").cast("long"))
    return stored(rows.mapInArrow(write, "path string, records long, bytes long"), "archives")


def read_archives(files: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """A row per record of the listed files, each file in a task of its own."""
    names = RECORDS if with_payload else RECORDS.rpartition(", ")[0]
    width = names.count(",") + 1
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(n, kinds[t]) for n, t in (x.split() for x in names.split(", "))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with system.open_input_stream(path, compression=None) as stream:
                    rows, size = [], 0
                    for record in read_archive(stream, path):
                        rows.append(record[:width])
                        size += len(record[6]) * with_payload + 200
                        if size > 1 << 22:
                            yield _batch(rows, schema)
                            rows, size = [], 0
                    if rows:
                        yield _batch(rows, schema)

    return files.select("path").repartition(max(1, files.count())).mapInArrow(read, names)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def archive_folder(spark) -> str:
    folder = f"{shared_folder(spark)}/footfall-{uuid.uuid4().hex}/warc"
    return folder if "://" in folder or folder.startswith("/") else f"/{folder}"


def round_trip(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Writes the pages to archives in the shared folder and reads the records back, without their payloads."""
    folder = archive_folder(pages.sparkSession)
    files = write_archives(mark_revisits(pages, key, html), folder, train_dictionary(pages, key, html), key, url, html)
    return read_archives(files, folder, with_payload=False)
