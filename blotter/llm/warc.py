"""Operator 9: seekable Zstandard bundles of WARC records.

Records are grouped into independent Zstandard frames; a bundle is the frames,
a skippable frame that maps record ids to (frame, offset in the frame, length),
and a footer seek table in the seekable format (a skippable frame that ends
with its magic number).  Any Zstandard reader can stream a bundle; a seeking
reader decompresses one frame to fetch one record.

Bundles are files written by Spark's own committed writer on whatever store
the path names, so a lost executor leaves no half bundle: the text writer puts
a bundle's bytes out unchanged and, as its line separator, the four bytes of
the footer's magic number.

Equal payloads of at least ``min_revisit`` bytes: the record with the largest
id is the response, the others are revisits that refer to it and hold no
payload.

Defined results: a null payload is empty; a null id is always a response and
comes back as null; rows that repeat both id and payload are written each, and
all of them are responses when their id is the largest; a payload of any
length is one record of one frame; an empty table gives no bundle and an empty
result; null urls give an empty target; extra columns are ignored."""

from __future__ import annotations

import base64
import hashlib
import json
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.llm.common import ship_package, to_batch

# Fixed values of the Zstandard skippable frame and seekable format.
SKIPPABLE = 0x184D2A5E
INDEX_FRAME = 0x184D2A50
SEEK_MAGIC = b"\xb1\xea\x92\x8f"

FRAME_BYTES = 256 * 1024
BUNDLE_BYTES = 8 * 1024 * 1024
MIN_REVISIT = 1000

BUNDLES = T.StructType([T.StructField("bundle", T.StringType()), T.StructField("body", T.BinaryType())])
RECORDS = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload_digest", T.StringType()), T.StructField("record_type", T.StringType()),
    T.StructField("refers_to", T.LongType()), T.StructField("url", T.StringType()),
    T.StructField("bundle", T.StringType()), T.StructField("frame", T.IntegerType()),
    T.StructField("frame_offset", T.LongType()), T.StructField("record_bytes", T.LongType()),
    T.StructField("payload", T.BinaryType())])


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; the block is an HTTP response (headers only for a revisit)."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:x-page:{'' if page_id is None else page_id}>", f"WARC-Target-URI: {target}",
            f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:x-page:{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return ("\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


@dataclass
class Record:
    page_id: int | None
    url: str
    digest: str
    payload_bytes: int
    refers_to: int | None
    payload: bytes | None


def _page(value: str) -> int | None:
    number = value.strip("<>").rpartition(":")[2]
    return int(number) if number else None


def parse_record(raw: bytes) -> Record:
    """The record of exactly the bytes ``raw``; a response's digest is taken anew
    from its payload and must agree with its header."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if lines[0] != "WARC/1.1" or rest[len(block):] != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    if fields["WARC-Type"] == "revisit":
        return Record(_page(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], digest, size,
                      _page(fields["WARC-Refers-To"]), None)
    if hashlib.sha1(payload).hexdigest() != digest or len(payload) != size:
        raise ValueError("payload does not agree with its digest")
    return Record(_page(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], digest, size, None, payload)


class BundleBuilder:
    """Collects records into frames and frames into one bundle."""

    def __init__(self, frame_bytes: int, level: int = 3):
        self.frame_bytes, self.compressor = frame_bytes, zstandard.ZstdCompressor(level=level)
        self.frames: list[tuple[bytes, int]] = []
        self.index: list[tuple[str, int, int, int]] = []
        self.open, self.filled, self.size = [], 0, 0

    def add(self, record_id: str, raw: bytes) -> None:
        self.index.append((record_id, len(self.frames), self.filled, len(raw)))
        self.open.append(raw)
        self.filled += len(raw)
        if self.filled >= self.frame_bytes:
            self.close_frame()

    def close_frame(self) -> None:
        if self.open:
            packed = self.compressor.compress(b"".join(self.open))
            self.frames.append((packed, self.filled))
            self.size += len(packed)
            self.open, self.filled = [], 0

    def body(self) -> bytes:
        self.close_frame()
        listing = self.compressor.compress(json.dumps(self.index).encode())
        table = b"".join(struct.pack("<II", len(c), n) for c, n in self.frames)
        table += struct.pack("<IB", len(self.frames), 0)
        return b"".join([*(c for c, _ in self.frames), struct.pack("<II", INDEX_FRAME, len(listing)), listing,
                         struct.pack("<II", SKIPPABLE, len(table) + len(SEEK_MAGIC)), table, SEEK_MAGIC])


class BundleReader:
    """Random access to one bundle through its footer."""

    def __init__(self, body: bytes):
        if body[-4:] != SEEK_MAGIC:
            raise ValueError("no seek table at the end")
        count = struct.unpack("<I", body[-9:-5])[0]
        at = len(body) - 9 - 8 * count
        if struct.unpack("<II", body[at - 8:at]) != (SKIPPABLE, 8 * count + 9):
            raise ValueError("broken seek table")
        sizes = [struct.unpack_from("<II", body, at + 8 * i) for i in range(count)]
        self.body, self.starts = body, [0]
        for packed, _ in sizes:
            self.starts.append(self.starts[-1] + packed)
        magic, length = struct.unpack_from("<II", body, self.starts[-1])
        if magic != INDEX_FRAME:
            raise ValueError("no record index")
        begin = self.starts[-1] + 8
        self.decompressor = zstandard.ZstdDecompressor()
        self.index = [tuple(x) for x in json.loads(self.decompressor.decompress(body[begin:begin + length]))]

    def frame(self, i: int) -> bytes:
        return self.decompressor.decompress(self.body[self.starts[i]:self.starts[i + 1]])

    def records(self, wanted: set[str] | None = None) -> Iterator[tuple[int, int, int, bytes]]:
        """(frame, offset, length, bytes) of the records; only frames that hold a
        wanted record are decompressed, each once."""
        held, data = -1, b""
        for record_id, frame, offset, length in self.index:
            if wanted is None or record_id in wanted:
                if frame != held:
                    held, data = frame, self.frame(frame)
                yield frame, offset, length, data[offset:offset + length]


def with_revisits(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """page_id, url, payload, digest, refers_to.  Which record of equal payloads
    answers is found on thin rows (id, digest, length); the payloads are
    joined to that by page id, so a hot payload never meets in one task."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    full = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        payload.alias("payload"))
    thin = full.select("page_id", F.sha1("payload").alias("digest"), F.octet_length("payload").alias("n")).where(F.col("n") >= min_revisit)
    answer = (thin.groupBy("digest", "n").agg(F.max("page_id").alias("winner"), F.count("*").alias("copies")).where("copies > 1")
              .select(F.col("digest").alias("__d"), F.col("n").alias("__n"), "winner"))
    revisits = (thin.join(answer, (F.col("digest") == F.col("__d")) & (F.col("n") == F.col("__n")))
                .where("page_id <> winner").select(F.col("page_id").alias("__id"), F.col("digest").alias("__digest"), "winner").distinct())
    full = full.withColumn("digest", F.sha1("payload"))
    return (full.join(revisits, (F.col("page_id") == F.col("__id")) & (F.col("digest") == F.col("__digest")), "left")
            .select("page_id", "url", "payload", "digest", F.col("winner").alias("refers_to")))


def write_bundles(spark: SparkSession, pages: DataFrame, path: str, frame_bytes: int = FRAME_BYTES,
                  bundle_bytes: int = BUNDLE_BYTES, min_revisit: int = MIN_REVISIT) -> None:
    """Write ``pages`` (page_id, url, html) as bundles below ``path``, one file
    per bundle; a task holds one open bundle."""

    ship_package(spark)

    def bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, made, builder = TaskContext.get().partitionId(), 0, BundleBuilder(frame_bytes)
        for b in batches:
            for page_id, url, payload, digest, refers in zip(*(c.to_pylist() for c in b.columns), strict=True):
                raw = record_bytes(page_id, url, payload, digest, refers)
                builder.add("" if page_id is None else str(page_id), raw)
                if builder.size >= bundle_bytes:
                    yield to_batch({"bundle": [f"{part:06d}-{made:06d}"], "body": [builder.body()[:-4]]}, BUNDLES)
                    made, builder = made + 1, BundleBuilder(frame_bytes)
        if builder.index:
            yield to_batch({"bundle": [f"{part:06d}-{made:06d}"], "body": [builder.body()[:-4]]}, BUNDLES)

    (with_revisits(pages, min_revisit).mapInArrow(bundles, BUNDLES)
     .select("bundle", F.col("body").cast("string").alias("value"))
     .write.partitionBy("bundle").option("encoding", "ISO-8859-1").option("lineSep", SEEK_MAGIC.decode("latin-1"))
     .text(path))


def read_bundles(spark: SparkSession, path: str, ids: list[int] | None = None, payloads: bool = True) -> DataFrame:
    """The records of all bundles below ``path``, or those of ``ids`` (a stated
    list): only the frames that hold them are decompressed."""
    ship_package(spark)
    wanted = None if ids is None else {str(i) for i in ids}

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for bundle, body in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                reader, rows, held = BundleReader(body.as_py()), [], 0
                for frame, offset, length, raw in reader.records(wanted):
                    r = parse_record(raw)
                    rows.append((r.page_id, r.payload_bytes, r.digest, "response" if r.refers_to is None else "revisit",
                                 r.refers_to, r.url, bundle, frame, offset, length, r.payload if payloads else None))
                    held += length if payloads else 0
                    if len(rows) >= 5000 or held > 8_000_000:
                        yield to_batch(dict(zip(RECORDS.names, zip(*rows, strict=True), strict=True)), RECORDS)
                        rows, held = [], 0
                if rows:
                    yield to_batch(dict(zip(RECORDS.names, zip(*rows, strict=True), strict=True)), RECORDS)

    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
             .select(F.regexp_extract("path", "/bundle=([^/]+)/", 1).alias("bundle"), "content"))
    return files.select("bundle", "content").mapInArrow(records, RECORDS)
