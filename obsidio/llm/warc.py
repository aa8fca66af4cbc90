"""WARC records in seekable Zstandard bundles.

A bundle is one file. Records are grouped into independent Zstandard frames; two skippable frames follow: the index, which
maps record ids to (frame, offset in the frame, length), and the seek table of the Zstandard seekable format, which ends
the file. Any Zstandard reader reads the whole file as a WARC file; a reader that seeks needs the last bytes and one frame.

Spark writes the files, so that they land on any file system that it knows, under its commit protocol: a lost task leaves
nothing behind. Its text writer ends each row with a separator. Rows are frames here, and the separator is made part of
the format: it is the content of a three-byte skippable frame after each frame, and the last three bytes of the seek
table's closing magic number, which happen to spell one character in UTF-8. A task rolls over to the next bundle when one is
full: every bundle but a task's last has BUNDLE_ROWS rows, and the writer begins a file after so many. One that is full by
its bytes is filled up with skippable frames of eleven bytes.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import materialise, maybe_in, scratch_path, slices

#: The last three bytes of the seek table's magic number 0x8F92EAB1.
SEPARATOR = "꒏"
SEEK_MAGIC = 0x8F92EAB1
SKIPPABLE_PAD, SKIPPABLE_INDEX, SKIPPABLE_SEEK = 0x184D2A50, 0x184D2A51, 0x184D2A5E
PAD = struct.pack("<II", SKIPPABLE_PAD, 3)
#: Bytes of records that a frame holds, one larger record aside.
FRAME_BYTES = 256 << 10
#: Frames and tail of a full bundle, as rows, and bytes of frames that close a bundle before that.
BUNDLE_ROWS, BUNDLE_BYTES = 512, 64 << 20
LEVEL = 3
ENTRY = "<?qIIQ"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAME = "urn:page:"


def _record(page_id: int | None, url: str | None, payload: bytes, sha1: str, size: int, refers_to: int | None, revisit: bool) -> bytes:
    """One record. A revisit has the HTTP header alone; ``size`` and ``sha1`` are of the full payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{NAME}{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    head.append(f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(sha1)).decode()}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{NAME}{'' if refers_to is None else refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(record: bytes) -> dict:
    """Headers and payload of one record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    number = lambda x: int(x[len(NAME) + 1 : -1]) if x and len(x) > len(NAME) + 2 else None
    return {
        "page_id": number(fields["WARC-Record-ID"]), "record_type": fields["WARC-Type"], "url": fields.get("WARC-Target-URI"),
        "payload": payload, "digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"), "refers_to": number(fields.get("WARC-Refers-To")),
        "size": int(re.search(rb"Content-Length: (\d+)", http)[1]),
    }


class BundleWriter:
    """Turns records into the rows of bundles. Holds one frame and one bundle's index."""

    def __init__(self, frame_bytes: int, bundle_rows: int, bundle_bytes: int):
        self.frame_bytes, self.bundle_rows, self.bundle_bytes = frame_bytes, bundle_rows, bundle_bytes
        self.packer = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True, write_checksum=True)
        self.open, self.filled = [], 0
        self._begin()

    def _begin(self) -> None:
        self.sizes: list[tuple[int, int]] = []  # compressed and decompressed, of each frame, skippable ones too
        self.index: list[tuple[bool, int, int, int, int]] = []
        self.rows, self.bytes = 0, 0

    def add(self, record: bytes, page_id: int | None) -> Iterator[bytes]:
        """Take a record; the rows that are full now."""
        self.index.append((page_id is not None, page_id or 0, len(self.sizes), self.filled, len(record)))
        self.open.append(record)
        self.filled += len(record)
        if self.filled >= self.frame_bytes:
            yield self._frame()
            if self.rows == self.bundle_rows - 1 or self.bytes >= self.bundle_bytes:
                while self.rows < self.bundle_rows - 1:
                    self.sizes.append((len(PAD) + 3, 0))
                    self.rows += 1
                    yield PAD
                yield self._tail()
                self._begin()

    def _frame(self) -> bytes:
        data = b"".join(self.open)
        packed = self.packer.compress(data)
        self.sizes += [(len(packed), len(data)), (len(PAD) + 3, 0)]
        self.open, self.filled = [], 0
        self.rows, self.bytes = self.rows + 1, self.bytes + len(packed)
        return packed + PAD

    def end(self) -> Iterator[bytes]:
        if self.open:
            yield self._frame()
        if self.sizes:
            yield self._tail()

    def _tail(self) -> bytes:
        index = zstandard.ZstdCompressor(level=LEVEL).compress(b"".join(struct.pack(ENTRY, *x) for x in self.index))
        index = struct.pack("<IIQ", SKIPPABLE_INDEX, len(index) + 8, len(self.index)) + index
        sizes = [*self.sizes, (len(index), 0)]
        entries = b"".join(struct.pack("<II", *x) for x in sizes)
        footer = struct.pack("<IBI", len(sizes), 0, SEEK_MAGIC)
        table = struct.pack("<II", SKIPPABLE_SEEK, len(entries) + len(footer)) + entries + footer
        return index + table[:-3]  # the separator is the rest


class RangedFile:
    """A file of any file system that Spark knows, read by ranges on the driver."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        place = self.jvm.org.apache.hadoop.fs.Path(path)
        files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.size, self.stream, self.read = files.getFileStatus(place).getLen(), files.open(place), 0

    def __len__(self) -> int:
        return self.size

    def __getitem__(self, at: slice) -> bytes:
        first, end, _ = at.indices(self.size)
        self.stream.seek(first)
        self.read += max(0, end - first)
        return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(self.stream, max(0, end - first)))


class Bundle:
    """A bundle's bytes, or any object that slices like them."""

    def __init__(self, data):
        self.data = data
        frames, flags, magic = struct.unpack("<IBI", bytes(data[len(data) - 9 :]))
        if magic != SEEK_MAGIC:
            raise ValueError("no seek table")
        size = 12 if flags & 0x80 else 8
        table = bytes(data[len(data) - 9 - frames * size : len(data) - 9])
        self.frames, at = [], 0
        for i in range(frames):
            packed, raw = struct.unpack_from("<II", table, i * size)
            self.frames.append((at, packed, raw))
            at += packed
        start, packed, _ = self.frames[-1]
        head = struct.unpack("<IIQ", bytes(data[start : start + 16]))
        width = struct.calcsize(ENTRY)
        body = zstandard.ZstdDecompressor().decompress(bytes(data[start + 16 : start + packed]), max_output_size=head[2] * width)
        entries = (struct.unpack_from(ENTRY, body, i * width) for i in range(head[2]))
        self.index = [(page_id if named else None, *place) for named, page_id, *place in entries]
        self.unpacker = zstandard.ZstdDecompressor()

    def frame(self, i: int) -> bytes:
        at, packed, raw = self.frames[i]
        return self.unpacker.decompress(bytes(self.data[at : at + packed]), max_output_size=raw)

    def fetch(self, page_id: int | None) -> list[dict]:
        """The records of an id, or those without one; one frame is read for each."""
        return [parse_record(self.frame(f)[at : at + n]) for i, f, at, n in self.index if i == page_id]

    def records(self) -> Iterator[tuple[int, int, int, dict]]:
        """Frame, offset in it, length and parsed record of every record, frame by frame."""
        now, data = -1, b""
        for _, f, at, n in self.index:
            if f != now:
                now, data = f, self.frame(f)
            yield f, at, n, parse_record(data[at : at + n])


def plan_records(pages: DataFrame, least: int = 0) -> DataFrame:
    """Each page with its payload, digest, record type and the id that a revisit refers to.

    Of pages with equal payloads of ``least`` bytes or more, that with the largest page_id is the response. Payloads are
    compared by SHA-256 and length. Only pages whose payload may occur twice, and no others, are shuffled.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string").cast("binary"), F.lit(b"")).alias("payload")
    ).withColumn("sha256", F.unhex(F.sha2("payload", 256)))
    largest = rows.filter(F.octet_length("payload") >= least).groupBy("sha256").agg(F.max("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    shared = materialise(largest.filter(F.col("n") > 1).select("sha256", "first_id"), "warc-shared")
    again = maybe_in(rows, shared, "sha256").join(shared, "sha256", "left")
    once = maybe_in(rows, shared, "sha256", keep=False).withColumn("first_id", F.lit(None).cast("long"))
    planned = again.unionByName(once)
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return planned.select(
        "page_id",
        "url",
        F.when(~revisit, F.col("payload")).alias("payload"),
        F.sha1("payload").alias("sha1"),
        F.octet_length("payload").cast("long").alias("size"),
        F.when(revisit, F.col("first_id")).alias("refers_to"),
        revisit.alias("revisit"),
    )


def write_bundles(pages: DataFrame, path: str, least: int = 0, frame_bytes: int = FRAME_BYTES, bundle_rows: int = BUNDLE_ROWS, bundle_bytes: int = BUNDLE_BYTES) -> None:
    """Write a record for each row of ``pages`` (page_id, url, html) into bundles under ``path``, one or more for each task.

    A null html is an empty payload, a null url has no target header, a null page_id an empty record name. Pages with
    equal payloads and the same, largest page_id are all responses. Extra columns are ignored; an empty table writes no
    bundle. A task holds one frame, so that the length of a page bounds its memory.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle = BundleWriter(frame_bytes, bundle_rows, bundle_bytes)
        row = lambda x: pa.RecordBatch.from_arrays([pa.array([x], pa.binary())], ["frame"])
        for piece in slices(batches, "payload"):
            for x in piece.to_pylist():
                record = _record(x["page_id"], x["url"], x["payload"] or b"", x["sha1"], x["size"], x["refers_to"], x["revisit"])
                for done in bundle.add(record, x["page_id"]):
                    yield row(done)
        for x in bundle.end():
            yield row(x)

    frames = plan_records(pages, least).mapInArrow(run, "frame binary")
    frames.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", SEPARATOR).option("maxRecordsPerFile", bundle_rows).option("compression", "none").text(path)


def read_bundles(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """All records of the bundles under ``path``: page_id, url, record_type, refers_to, payload, payload_bytes,
    payload_digest, bundle, frame, offset, length.

    The digest of a response is that of the payload read, and must be the one in its header. ``payloads`` off leaves the
    payload null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "content", 1):
            name, data = piece.column(0)[0].as_py(), memoryview(piece.column(1)[0].as_buffer())
            if not len(data):
                continue
            rows, held = [], 0
            for frame, at, n, x in Bundle(data).records():
                digest, size = x["digest"], x["size"]
                if x["record_type"] == "response":
                    digest, size = base64.b32encode(hashlib.sha1(x["payload"]).digest()).decode(), len(x["payload"])
                    if (digest, size) != (x["digest"], x["size"]):
                        raise ValueError(f"{name}: record {x['page_id']} is damaged")
                payload = x["payload"] if payloads and x["record_type"] == "response" else None
                rows.append((x["page_id"], x["url"], x["record_type"], x["refers_to"], payload, size, digest, name, frame, at, n))
                held += n if payloads else 0
                if len(rows) >= 5000 or held >= 8 << 20:
                    yield batch_of(rows)
                    rows, held = [], 0
            if rows:
                yield batch_of(rows)

    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
    names = ["page_id", "url", "record_type", "refers_to", "payload", "payload_bytes", "payload_digest", "bundle", "frame", "offset", "length"]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    schema = "page_id long, url string, record_type string, refers_to long, payload binary, payload_bytes long, payload_digest string, bundle string, frame int, offset long, length long"
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return files.mapInArrow(run, schema)


def open_bundle(spark: SparkSession, path: str) -> Bundle:
    """A bundle of which only the seek table, the index and the frames asked for are read."""
    return Bundle(RangedFile(spark, path))


def archive(pages: DataFrame, payloads: bool = False) -> DataFrame:
    """Write ``pages`` into bundles in the shared folder and read them back."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_bundles(pages, path)
    return read_bundles(spark, path, payloads)
