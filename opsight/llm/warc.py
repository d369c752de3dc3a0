"""WARC archives as seekable Zstandard bundles.

Each page becomes a WARC/1.1 record. Records are grouped into independent Zstandard frames of about
``FRAME_BYTES``; a bundle ends with a seek table in a skippable frame (the public seekable format), and
an index maps each record id to its bundle, frame, and offset within the frame, so one record is read
by seeking to its frame and decompressing that frame only.

Among records with equal payloads of at least 1000 bytes (equal SHA-1 and length) the one with the
largest page_id is a response, the others are revisit records that refer to it and carry no payload.
Pages without a page_id are always responses. NULL html is an empty payload. Record ids are made of
page_id and payload digest, so pages that repeat a page_id with another payload have records of their own, each decided by
its own payload. Repeated rows are written and read as separate records; a row whose page_id is the group's largest is a response.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsight.llm.common import shared_table
from opsight.session import shared_path

REVISIT_BYTES = 1000
FRAME_BYTES = 256 * 1024
BUNDLE_BYTES = 64 * 1024 * 1024
LEVEL = 3
# Fixed values of the seekable format: skippable frame, seek table footer.
_SKIPPABLE, _SEEKABLE = 0x184D2A5E, 0x8F92EAB1
_WARC_DATE = "2024-01-01T00:00:00Z"

INDEX = "page_id long, record_id string, bundle string, frame int, offset long, length long"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


def _uri(page_id: int | None, digest: str) -> str:
    return f"urn:page:{'' if page_id is None else page_id}:{digest}"


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record. A revisit names its response and has an empty block."""
    kind = "response" if refers_to is None else "revisit"
    block = payload if refers_to is None else b""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{_uri(page_id, digest)}>", f"WARC-Date: {_WARC_DATE}",
             "WARC-Target-URI: " + (url or "").replace("\r", "%0D").replace("\n", "%0A"),
             f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Payload-Length: {len(payload)}", f"Content-Length: {len(block)}"]
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: <{_uri(refers_to, digest)}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record in the bytes of a frame."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:end].decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no WARC record at {at}")
        headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(": "), "") for line in lines)
        length = int(headers["Content-Length"])
        yield headers, data[end + 4:end + 4 + length]
        at = end + 4 + length + 4


class BundleWriter:
    """Writes one bundle: frames as they fill, then the seek table; the file appears only when complete."""

    def __init__(self, folder: str, name: str):
        self.fs, root = pafs.FileSystem.from_uri(folder)
        self.path, self.name = f"{root}/{name}", name
        self.fs.create_dir(root, recursive=True)
        context = TaskContext.get()
        self.part = f"{self.path}.{context.taskAttemptId() if context else 0}.part"
        self.out = self.fs.open_output_stream(self.part)
        self.held, self.size, self.frames, self.written = [], 0, [], 0
        self.packer = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)

    def add(self, record: bytes) -> tuple[int, int]:
        """Frame and offset of the record."""
        if self.size and self.size + len(record) > FRAME_BYTES:
            self._flush()
        place = (len(self.frames), self.size)
        self.held.append(record)
        self.size += len(record)
        return place

    def _flush(self) -> None:
        if self.size:
            packed = self.packer.compress(b"".join(self.held))
            self.out.write(packed)
            self.frames.append((len(packed), self.size))
            self.written += len(packed)
            self.held, self.size = [], 0

    def close(self) -> None:
        self._flush()
        table = b"".join(struct.pack("<II", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), 0, _SEEKABLE)
        self.out.write(struct.pack("<II", _SKIPPABLE, len(table)) + table)
        self.out.close()
        self.fs.move(self.part, self.path)


class BundleReader:
    """Random access to the frames of a bundle by its seek table."""

    def __init__(self, folder: str, name: str):
        fs, root = pafs.FileSystem.from_uri(folder)
        self.file = fs.open_input_file(f"{root}/{name}")
        size = self.file.size()
        count, _, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != _SEEKABLE:
            raise ValueError(f"{name} has no seek table")
        sizes = struct.iter_unpack("<II", self.file.read_at(8 * count, size - 9 - 8 * count))
        self.places, at = [], 0
        for packed, plain in sizes:
            self.places.append((at, packed, plain))
            at += packed

    def frame(self, k: int) -> bytes:
        at, packed, plain = self.places[k]
        return zstandard.ZstdDecompressor().decompress(self.file.read_at(packed, at), max_output_size=plain)

    def record(self, frame: int, offset: int, length: int) -> tuple[dict[str, str], bytes]:
        return next(parse_records(self.frame(frame)[offset:offset + length]))


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, bundle, n = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            rows = []
            for page_id, url, html, refers_to in zip(*[c.to_pylist() for c in batch.columns]):
                payload = (html or "").encode()
                digest = hashlib.sha1(payload).hexdigest()
                record = record_bytes(page_id, url, payload, digest, refers_to)
                if bundle is not None and bundle.written > BUNDLE_BYTES:
                    bundle.close()
                    bundle = None
                if bundle is None:
                    bundle, n = BundleWriter(folder, f"part-{part:06d}-{n:04d}.warc.zst"), n + 1
                rows.append((page_id, f"<{_uri(page_id, digest)}>", bundle.name, *bundle.add(record), len(record)))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()))],
                    [f.split()[0] for f in INDEX.split(", ")])
        if bundle is not None:
            bundle.close()
    return run


def record_kinds(marks: DataFrame) -> DataFrame:
    """``(page_id, digest, n, refers_to)`` of the pages in ``marks(page_id, digest, n)`` that become revisit records."""
    marks = shared_table(marks.filter((F.col("n") >= REVISIT_BYTES) & F.col("page_id").isNotNull()), "marks")
    groups = (marks.groupBy("digest", "n").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("least"))
              .filter("least < refers_to").drop("least"))
    return marks.join(groups, ["digest", "n"]).filter("page_id < refers_to").distinct()


def write_archive(pages: DataFrame, folder: str) -> DataFrame:
    """Write ``pages(page_id, url, html)`` as bundles into ``folder`` (a URI) and return the index table.

    A task writes its own bundles; a repeated task writes the same files again. Pages are dealt by a
    hash of page_id and sorted within a task, so groups of copies do not meet in one task.
    """
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    html = F.coalesce("html", F.lit(""))
    marked = pages.withColumn("digest", F.sha1(html)).withColumn("n", F.octet_length(html))
    kinds = shared_table(record_kinds(marked.select("page_id", "digest", "n")), "revisits")
    rows = (marked.join(kinds, ["page_id", "digest", "n"], "left").repartition(F.xxhash64("page_id", "url"))
            .sortWithinPartitions("page_id", "url").select("page_id", "url", "html", "refers_to"))
    return shared_table(rows.mapInArrow(_write(folder), INDEX), "index")


def _read(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                reader = BundleReader(folder, name)
                for k in range(len(reader.places)):
                    rows = []
                    for headers, block in parse_records(reader.frame(k)):
                        revisit = headers["WARC-Type"] == "revisit"
                        digest = headers["WARC-Payload-Digest"].removeprefix("sha1:") if revisit else hashlib.sha1(block).hexdigest()
                        length = int(headers["WARC-Payload-Length"]) if revisit else len(block)
                        refers = _page(headers["WARC-Refers-To"]) if revisit else None
                        rows.append((_page(headers["WARC-Record-ID"]), length, digest, headers["WARC-Type"], refers,
                                     headers["WARC-Target-URI"]))
                    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                                     [f.split()[0] for f in RECORDS.split(", ")])
    return run


def _page(uri: str) -> int | None:
    number = uri.strip("<>").removeprefix("urn:page:").split(":")[0]
    return int(number) if number else None


def read_archive(spark: SparkSession, index: DataFrame, folder: str) -> DataFrame:
    """All records of the bundles that ``index`` lists, read frame by frame; response digests are computed anew."""
    bundles = shared_table(index.select("bundle").distinct(), "bundles")
    # a task for each bundle: without a number such narrow rows would be merged into one task
    return bundles.repartition(max(1, bundles.count()), "bundle").mapInArrow(_read(folder), RECORDS)


def archive_report(pages: DataFrame) -> DataFrame:
    """Write the pages to a new archive in the shared folder, and what is read back from it."""
    spark = pages.sparkSession
    folder = shared_path(spark, "warc")
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    folder = "file://" + folder[5:] if folder.startswith("file:/") and not folder.startswith("file://") else folder
    index = write_archive(pages, folder)
    return read_archive(spark, index, folder)
