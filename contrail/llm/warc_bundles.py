"""WARC records in seekable Zstandard bundles.

Records are grouped into frames of about ``FRAME_BYTES``, each compressed on its
own; a bundle file is some frames, a skippable frame with the record index
(record identifier -> frame number, offset and length inside the frame), and the
seek table of the published seekable format, whose footer ends the file. Any
frame can be read without the others.

Records with equal payloads are written once: the row with the smallest id is the
response, the others are revisit records that refer to it.

Files are written by Spark's text writer, one row a file, with the last four
bytes of the footer (the seek table's magic number) as the line end: so writes
work in any store that Spark writes to, commit as a job does, and survive lost
executors. They are read back as binary files.

Defined results: a null payload is an empty one; a null URL becomes a URN of the
id; rows that hold the smallest id of their payload more than once are all
responses; a null id refers to nothing and is never referred to; extra columns
are not read; an empty table gives no records.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm.common import shared_table

FRAME_BYTES = 256 * 1024
BUNDLE_BYTES = 8 * 1024 * 1024
LEVEL = 3
BROADCAST_ROWS = 100_000

# Fixed values of the formats.
SEEK_TABLE_MAGIC = 0x184D2A5E
INDEX_MAGIC = 0x184D2A50
FOOTER_MAGIC = 0x8F92EAB1
CHECKSUMS = 0x80
LINE_END = struct.pack("<I", FOOTER_MAGIC).decode("latin-1")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"  # the tables hold no capture time
SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:contrail:warc-record")


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, f'{page_id}|{digest}')}>"


def plain_url(url: str | None, page_id: int | None) -> str:
    if not url:
        return f"urn:contrail:page:{page_id}"
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)


def make_record(page_id: int | None, url: str | None, payload: bytes, first_id: int | None) -> tuple[str, bytes]:
    """(record identifier, record bytes); ``first_id`` is the row referred to, None for a response."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    own = record_id(page_id, digest)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if first_id is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if first_id is None else 'revisit'}",
        f"WARC-Record-ID: {own}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {plain_url(url, page_id)}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if first_id is not None:
        head += [f"WARC-Refers-To: {record_id(first_id, digest)}", f"X-Refers-To-Page-Id: {first_id}", f"WARC-Profile: {REVISIT_PROFILE}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return own, "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class Bundle:
    """Collects records into frames; ``finish`` gives the file's bytes without its last four."""

    def __init__(self):
        self.frames, self.table, self.index = [], [], []
        self.open, self.open_bytes, self.bytes = [], 0, 0

    def add(self, own: str, record: bytes) -> None:
        self.index.append((own, len(self.frames), self.open_bytes, len(record)))
        self.open.append(record)
        self.open_bytes += len(record)
        if self.open_bytes >= FRAME_BYTES:
            self.close_frame()

    def close_frame(self) -> None:
        if self.open:
            plain = b"".join(self.open)
            packed = zstandard.ZstdCompressor(level=LEVEL).compress(plain)
            self.append(packed, len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF)
            self.open, self.open_bytes = [], 0

    def append(self, packed: bytes, size: int, checksum: int) -> None:
        self.frames.append(packed)
        self.table.append(struct.pack("<III", len(packed), size, checksum))
        self.bytes += len(packed)

    def finish(self) -> bytes:
        self.close_frame()
        index = zstandard.ZstdCompressor(level=LEVEL).compress(json.dumps(self.index).encode())
        self.append(struct.pack("<II", INDEX_MAGIC, len(index)) + index, 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF)
        table = b"".join(self.table)
        seek = struct.pack("<II", SEEK_TABLE_MAGIC, len(table) + 9) + table + struct.pack("<IB", len(self.table), CHECKSUMS)
        return b"".join(self.frames) + seek


class BundleReader:
    """Random access to the bytes of a bundle file."""

    def __init__(self, content: bytes):
        self.content = content
        n, flags, magic = struct.unpack("<IBI", content[-9:])
        if magic != FOOTER_MAGIC or flags != CHECKSUMS:
            raise ValueError("not a seekable bundle")
        at = len(content) - 9 - 12 * n
        self.table = [struct.unpack_from("<III", content, at + 12 * i) for i in range(n)]
        self.offsets = [0]
        for packed, _, _ in self.table:
            self.offsets.append(self.offsets[-1] + packed)

    def index(self) -> list[tuple[str, int, int, int]]:
        """(record identifier, frame, offset in the frame, length) of every record."""
        at = self.offsets[-2]
        magic, size = struct.unpack_from("<II", self.content, at)
        if magic != INDEX_MAGIC:
            raise ValueError("bundle without a record index")
        return [tuple(x) for x in json.loads(zstandard.ZstdDecompressor().decompress(self.content[at + 8 : at + 8 + size]))]

    def frame(self, i: int) -> bytes:
        packed = self.content[self.offsets[i] : self.offsets[i + 1]]
        plain = zstandard.ZstdDecompressor().decompress(packed, max_output_size=max(self.table[i][1], 1))
        if len(plain) != self.table[i][1] or xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != self.table[i][2]:
            raise ValueError(f"frame {i} is damaged")
        return plain

    def records(self, wanted: set[str] | None = None) -> Iterator[tuple[str, bytes]]:
        """(identifier, bytes) of the records, or of the ``wanted`` ones; other frames stay packed."""
        current, plain = -1, b""
        for own, frame, offset, length in self.index():
            if wanted is None or own in wanted:
                if frame != current:
                    current, plain = frame, self.frame(frame)
                yield own, plain[offset : offset + length]


def parse_record(record: bytes) -> dict:
    """Fields of one record; checks the payload of a response against its digest."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")
    number = lambda name: int(fields[name]) if name in fields else None
    return {
        "page_id": number("X-Page-Id"), "record_id": fields["WARC-Record-ID"], "url": fields["WARC-Target-URI"],
        "payload_bytes": size, "payload_digest": digest, "record_type": kind,
        "refers_to": number("X-Refers-To-Page-Id"), "payload": payload if kind == "response" else None,
    }


RECORD_SCHEMA = (
    "page_id bigint, record_id string, url string, payload_bytes bigint, payload_digest string, record_type string, "
    "refers_to bigint, payload binary"
)
INDEX_SCHEMA = "path string, record_id string, frame int, frame_offset bigint, offset bigint, length bigint"


def with_first(pages: DataFrame, key: str, url: str, payload: str) -> DataFrame:
    """(id, url, payload, first_id): first_id is set on rows whose payload another, smaller id holds."""
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    read = pages.select(F.col(key).alias("id"), F.col(url).alias("url"), body.alias("payload"))
    digests = read.select("id", F.sha1("payload").alias("_sha1"))
    repeated = digests.groupBy("_sha1").agg(F.min("id").alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    firsts = shared_table(repeated.select("_sha1", "_first"), "warc-firsts")
    side = F.broadcast(firsts) if firsts.count() <= BROADCAST_ROWS else firsts  # the measured size decides
    joined = read.withColumn("_sha1", F.sha1("payload")).join(side, "_sha1", "left")
    other = F.when(~F.col("_first").eqNullSafe(F.col("id")), F.col("_first"))
    return joined.select("id", "url", "payload", other.alias("first_id"))


def write_bundles(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html") -> None:
    """Writes one record per row of ``pages`` into bundle files below ``path``."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bundle = Bundle()
        for batch in batches:
            first = [None if pd.isna(x) else int(x) for x in batch["first_id"]]
            ids = [None if pd.isna(x) else int(x) for x in batch["id"]]
            for page_id, address, body, other in zip(ids, batch["url"], batch["payload"], first):
                bundle.add(*make_record(page_id, address, bytes(body), other))
                if bundle.bytes >= BUNDLE_BYTES:
                    yield pd.DataFrame({"bundle": [bundle.finish()]})
                    bundle = Bundle()
        if bundle.index:
            yield pd.DataFrame({"bundle": [bundle.finish()]})

    ready = with_first(pages, key, url, payload).withColumns(
        {"id": F.col("id").cast("string"), "first_id": F.col("first_id").cast("string")}  # nullable integers as text: no rounding
    )
    files = ready.mapInPandas(pack, "bundle binary").select(F.col("bundle").cast("string").alias("value"))
    files.write.option("encoding", "ISO-8859-1").option("lineSep", LINE_END).option("maxRecordsPerFile", 1).option(
        "compression", "none"
    ).mode("overwrite").text(path)


def bundle_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).filter("length > 0").select("path", "content")


def read_records(spark: SparkSession, path: str, wanted: list[str] | None = None) -> DataFrame:
    """The records below ``path`` (``RECORD_SCHEMA``); with ``wanted`` identifiers, only the frames that hold them are unpacked."""
    picked = set(wanted) if wanted is not None else None

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                rows, size = [], 0
                for _, record in BundleReader(bytes(content)).records(picked):
                    rows.append(parse_record(record))
                    size += len(record)
                    if size >= BUNDLE_BYTES:
                        yield as_frame(rows)
                        rows, size = [], 0
                if rows:
                    yield as_frame(rows)

    def as_frame(rows: list[dict]) -> pd.DataFrame:
        made = pd.DataFrame(rows)
        return made.astype({"page_id": "Int64", "refers_to": "Int64"})

    return bundle_files(spark, path).mapInPandas(unpack, RECORD_SCHEMA)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Where every record lies (``INDEX_SCHEMA``)."""

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"]):
                reader = BundleReader(bytes(content))
                rows = [(name, own, frame, reader.offsets[frame], at, size) for own, frame, at, size in reader.index()]
                yield pd.DataFrame(rows, columns=["path", "record_id", "frame", "frame_offset", "offset", "length"])

    return bundle_files(spark, path).mapInPandas(unpack, INDEX_SCHEMA)
