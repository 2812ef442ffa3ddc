"""Web archives: WARC files of one gzip member per record, and a splittable reader.

Writing: each task writes archives of its own and names them in the table it
returns; a retried task writes under a new name, and only the names of tasks
that succeeded are kept. Records of equal payload share one response; the others
are revisits of it.

Reading: an archive is cut into byte ranges. A task scans its range for the gzip
magic, accepts a candidate only if it inflates to a WARC header, and owns the
records that start inside its range, reading the last one beyond the range's end
where needed.
"""

from __future__ import annotations

import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import written
from millrace.session import shared_path

# Fixed values of the formats.
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Payloads shorter than this are always written in full.
LEAST_REVISITED = 100
SPLIT_BYTES = 32 << 20
READ_BYTES = 1 << 16
ARCHIVE_BYTES = 1 << 30


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system and the path within it, for a path or URI that all executors share."""
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def record_id(key: int | None) -> str:
    return f"<urn:uuid:{uuid.UUID(int=key % (1 << 128)) if key is not None else uuid.UUID(int=(1 << 128) - 1)}>"


def record(archive: str, kind: str, key: int | None, url: str | None, date: str, payload: bytes, digest: str, size: int, refers_to: int | None) -> bytes:
    """One record as a gzip member. A revisit carries the payload's digest and size, not the payload.

    The first header names the archive, so that records of an archive that is
    itself a payload aren't taken for this one's.
    """
    lines = [
        VERSION.decode(), f"X-Archive-ID: {archive}", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(key)}", f"WARC-Date: {date}",
        f"WARC-Target-URI: {' '.join((url or '').split())}", f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {size}",
        "Content-Type: text/html; charset=utf-8",
    ]
    if key is not None:
        lines.append(f"X-Page-ID: {key}")
    if kind == "revisit":
        payload = b""
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page-ID: {refers_to}"]
    lines.append(f"Content-Length: {len(payload)}")
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n") + packer.flush()


def write_archives(pages: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z", id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """Write a record per row into archives under `folder`; returns (path, bytes, records) of each archive.

    Of rows with equal payloads of at least 100 bytes, that with the smallest id
    is the response (of repeated ones each), the others revisit it; rows without
    an id are always responses. A null payload is an empty one.
    """
    payload = F.coalesce(F.col(f"`{html_column}`"), F.lit("")).cast("binary")
    rows = pages.select(F.col(f"`{id_column}`").cast("long").alias("key"), F.col(f"`{url_column}`").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("size", F.octet_length("payload").cast("long"))
    repeated = (
        rows.where((F.col("size") >= LEAST_REVISITED) & F.col("key").isNotNull()).groupBy("digest")
        .agg(F.min("key").alias("first"), F.max("key").alias("last")).where(F.col("first") != F.col("last")).select("digest", "first")
    )
    rows = rows.join(repeated, "digest", "left")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, name, done, count = None, "", "", 0, 0

        def close() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([done], pa.int64()), pa.array([count], pa.int64())], names=["path", "bytes", "records"])

        for batch in batches:
            for digest, key, url, body, size, first in zip(*batch.columns, strict=True):
                if out is None:
                    name = uuid.uuid4().hex
                    path = f"{folder}/{name}.warc.gz"
                    fs, inside = opened(path)
                    fs.create_dir(inside.rpartition("/")[0], recursive=True)
                    out, done, count = fs.open_output_stream(inside, compression=None), 0, 0
                key, first = key.as_py(), first.as_py()
                revisits = first is not None and key is not None and key != first
                data = record(name, "revisit" if revisits else "response", key, url.as_py(), date, body.as_py(), digest.as_py(), size.as_py(), first)
                out.write(data)
                done, count = done + len(data), count + 1
                if done >= ARCHIVE_BYTES:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    ordered = rows.select("digest", "key", "url", "payload", "size", "first")
    return written(ordered.mapInArrow(write, "path string, bytes long, records long"), "archives")


class Members:
    """The gzip members of one file from a place on, inflated as streams."""

    def __init__(self, file, size: int, archive: str):
        self.file, self.size = file, size
        self.own = f"X-Archive-ID: {archive}\r\n".encode()

    def candidates(self, start: int, end: int) -> Iterator[int]:
        """Places in [start, end) where the gzip magic stands."""
        at, tail = start, b""
        stop = min(self.size, end + len(MAGIC) - 1)
        while at < stop:
            self.file.seek(at)
            data = self.file.read(min(READ_BYTES, stop - at))
            if not data:
                return
            window, base = tail + data, at - len(tail)
            k = window.find(MAGIC)
            while k >= 0:
                yield base + k
                k = window.find(MAGIC, k + 1)
            tail, at = window[-(len(MAGIC) - 1):], at + len(data)

    def is_record(self, at: int) -> bool:
        """Whether a gzip member starts here whose content is a WARC header, and not one of another archive."""
        self.file.seek(at)
        try:
            head = zlib.decompressobj(31).decompress(self.file.read(4096), len(VERSION) + 2 + len(self.own))
        except zlib.error:
            return False
        version, _, rest = head.partition(b"\r\n")
        return version == VERSION and (rest == self.own or not rest.startswith(b"X-Archive-ID:"))

    def member(self, at: int) -> tuple[bytes, int]:
        """The member's content and the place just behind it."""
        self.file.seek(at)
        unpack, out = zlib.decompressobj(31), io.BytesIO()
        while not unpack.eof:
            data = self.file.read(READ_BYTES)
            if not data:
                raise ValueError(f"the record at byte {at} is cut off")
            out.write(unpack.decompress(data))
        return out.getvalue(), self.file.tell() - len(unpack.unused_data)


def parsed(content: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and payload of a record."""
    head, _, rest = content.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8", "replace").split("\r\n")
    if version.encode() != VERSION:
        raise ValueError(f"not a WARC record: {version[:40]!r}")
    headers = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
    return headers, rest[:int(headers["content-length"])]


def records_in(file, size: int, archive: str, start: int, end: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(place, headers, payload) of the records that start in [start, end) of a file."""
    members = Members(file, size, archive)
    at = next((k for k in members.candidates(start, end) if members.is_record(k)), None)
    while at is not None and at < end:
        content, behind = members.member(at)
        yield at, *parsed(content)
        at = behind if behind < size else None


def byte_ranges(archives: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(path, size, start, end) of the ranges that the archives are read in."""
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(split_bytes).cast("long"))
    return archives.select("path", F.col("bytes").alias("size"), F.explode(starts).alias("start")).withColumn("end", F.least(F.col("start") + split_bytes, F.col("size")))


def read_archives(archives: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Every record of the archives (path, bytes): place, type, ids, url, digest, size and payload.

    `payload_digest` and `payload_bytes` of a response are computed from the
    payload read; those of a revisit are its headers'.
    """
    ranges = byte_ranges(archives, split_bytes)
    spread = ranges.repartitionByRange(max(1, ranges.count()), "path", "start")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["path", "offset", "record_type", "page_id", "url", "payload_digest", "payload_bytes", "refers_to", "payload"]
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        for batch in batches:
            for path, size, start, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                fs, inside = opened(path)
                archive = path.rpartition("/")[2].removesuffix(".warc.gz")
                rows, held = [], 0
                with fs.open_input_file(inside) as file:
                    for at, head, payload in records_in(file, size, archive, start, end):
                        revisit = head["warc-type"] == "revisit"
                        number = lambda name, head=head: int(head[name]) if name in head else None
                        digest = head["warc-payload-digest"].rpartition(":")[2] if revisit else hashlib.sha256(payload).hexdigest()
                        rows.append((
                            path, at, head["warc-type"], number("x-page-id"), head.get("warc-target-uri"), digest,
                            number("x-payload-length") if revisit else len(payload), number("x-refers-to-page-id") if revisit else None,
                            None if revisit else payload,
                        ))
                        held += len(payload) + 500
                        if held > 8 << 20:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    return spread.mapInArrow(
        read, "path string, offset long, record_type string, page_id long, url string, payload_digest string, payload_bytes long, refers_to long, payload binary"
    )


def archive_folder(spark: SparkSession) -> str:
    return shared_path(spark, "warc")
