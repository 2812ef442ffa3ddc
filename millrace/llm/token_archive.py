"""Token ids in compressed archive files, in ascending order of document id.

A file starts with a mark, holds blocks of at most `BLOCK_IDS` ids (each coded
from a fresh model, with the checksum of its ids), then the ids and lengths of
its documents, and ends with the place of that list. Documents follow each other
without gaps and may cross blocks. Files are written by tasks that each own a
range of document ids, so their order is the order of documents.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.chunk_tokens import ChunkEncoder
from millrace.llm.common import written
from millrace.llm.id_coder import decode_blocks, encode_blocks
from millrace.llm.warc import opened
from millrace.session import shared_path

# Fixed values of the file format.
MARK, END = b"TIDS0001", b"TIDSEND1"
BLOCK = "<III"  # ids, bytes of code, crc32 of the ids as 32-bit little-endian numbers
FOOTER = "<QQI8s"  # place of the document list, documents, crc32 of the list, END
BLOCK_IDS = 4096
# Blocks coded side by side; more cost memory, fewer cost time.
LANES = 1536


class ArchiveWriter:
    """Writes one file; ids are buffered until a set of blocks is full."""

    def __init__(self, file):
        self.file, self.place = file, 0
        self.waiting: list[np.ndarray] = []
        self.held = self.n_ids = 0
        self.docs: list[tuple[int, int, int]] = []
        self._write(MARK)

    def _write(self, data: bytes) -> None:
        self.file.write(data)
        self.place += len(data)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id is None, doc_id or 0, len(ids)))
        self.waiting.append(ids)
        self.held += len(ids)
        self.n_ids += len(ids)
        if self.held >= LANES * BLOCK_IDS:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint32)
        whole = len(ids) if last else len(ids) // BLOCK_IDS * BLOCK_IDS
        for begin in range(0, whole, LANES * BLOCK_IDS):
            part = ids[begin:min(whole, begin + LANES * BLOCK_IDS)]
            blocks = [part[k:k + BLOCK_IDS] for k in range(0, len(part), BLOCK_IDS)]
            for block, code in zip(blocks, encode_blocks(blocks), strict=True):
                self._write(struct.pack(BLOCK, len(block), len(code), zlib.crc32(block.astype("<u4").tobytes())) + code)
        self.waiting, self.held = [ids[whole:]], len(ids) - whole

    def close(self) -> None:
        self._flush(True)
        place = self.place
        data = np.array(self.docs, "<i8").tobytes()
        self._write(data)
        self._write(struct.pack(FOOTER, place, len(self.docs), zlib.crc32(data), END))
        self.file.close()


class ArchiveReader:
    """Reads one file block by block; a damaged block or list raises ValueError."""

    def __init__(self, file, size: int):
        self.file, self.size = file, size
        file.seek(size - struct.calcsize(FOOTER))
        self.list_place, n, crc, end = struct.unpack(FOOTER, file.read(struct.calcsize(FOOTER)))
        file.seek(self.list_place)
        data = file.read(24 * n)
        if end != END or zlib.crc32(data) != crc:
            raise ValueError("the archive's document list is damaged")
        self.docs = np.frombuffer(data, "<i8").reshape(n, 3)

    def blocks(self) -> Iterator[np.ndarray]:
        self.file.seek(0)
        if self.file.read(len(MARK)) != MARK:
            raise ValueError("not an archive of token ids")
        place, heads, codes = len(MARK), [], []
        while place < self.list_place:
            head = struct.unpack(BLOCK, self.file.read(struct.calcsize(BLOCK)))
            heads.append(head)
            codes.append(self.file.read(head[1]))
            place += struct.calcsize(BLOCK) + head[1]
            if len(codes) == LANES or place >= self.list_place:
                for k, ids in enumerate(decode_blocks(codes, [h[0] for h in heads])):
                    if zlib.crc32(ids.astype("<u4").tobytes()) != heads[k][2]:
                        raise ValueError("a block of the archive is damaged")
                    yield ids
                heads, codes = [], []

    def documents(self) -> Iterator[tuple[int | None, int, Iterator[np.ndarray]]]:
        """(doc_id, its place among the file's ids, its ids in parts); take all parts of one before the next."""
        blocks, rest, place = self.blocks(), np.zeros(0, np.uint32), 0

        def parts(n: int) -> Iterator[np.ndarray]:
            nonlocal rest
            while n:
                if not len(rest):
                    rest = next(blocks)
                part, rest = rest[:n], rest[n:]
                n -= len(part)
                yield part

        for missing, doc_id, n in self.docs.tolist():
            yield None if missing else doc_id, place, parts(n)
            place += n


def write_token_archives(df: DataFrame, tokenizer: str, end_id: int, id_column: str = "doc_id", text_column: str = "text", keeps_blanks: bool = True) -> DataFrame:
    """Write every document's ids, its end included; returns (part, path, bytes, documents, n_ids, start) of each file.

    A null text is an empty one and has the end id only. Rows without an id come
    first; rows that share an id follow each other. Other columns are not read.
    Without rows there is no file.
    """
    folder = shared_path(df.sparkSession, "token-archive")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, writer, path = ChunkEncoder(tokenizer, keeps_blanks), None, f"{folder}/{uuid.uuid4().hex}.tids"
        for batch in batches:
            texts = (t.as_py() for t in batch.column(1))
            for doc, ids in zip(batch.column(0).to_pylist(), encoder.encode_all(texts), strict=True):
                if writer is None:
                    fs, inside = opened(path)
                    fs.create_dir(inside.rpartition("/")[0], recursive=True)
                    writer = ArchiveWriter(fs.open_output_stream(inside, compression=None))
                writer.add(doc, np.append(ids, np.uint32(end_id)))
        if writer is not None:
            writer.close()
            row = {"part": TaskContext.get().partitionId(), "path": path, "bytes": writer.place, "documents": len(writer.docs), "n_ids": writer.n_ids}
            yield pa.RecordBatch.from_pylist([row], schema=pa.schema([("part", pa.int32()), ("path", pa.string()), ("bytes", pa.int64()), ("documents", pa.int64()), ("n_ids", pa.int64())]))

    plain = df.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text_column}`").alias("text"))
    ranged = plain.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    files = written(ranged.mapInArrow(write, "part int, path string, bytes long, documents long, n_ids long"), "token-files")
    # One row per file: a running total over them is small.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)))


def read_token_archives(files: DataFrame, with_ids: bool = False) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32
    (of the ids as unsigned 32-bit little-endian numbers), and on request the ids in that form."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    kinds = [pa.int64()] * 4 + [pa.binary()] * with_ids
    names = [part.split(" ")[0] for part in schema.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        for batch in batches:
            for path, size, begin in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                fs, inside = opened(path)
                rows, held = [], 0
                with fs.open_input_file(inside) as file:
                    for doc_id, place, parts in ArchiveReader(file, size).documents():
                        n = crc = 0
                        kept: list[bytes] = []
                        for part in parts:
                            data = part.astype("<u4").tobytes()
                            n, crc = n + len(part), zlib.crc32(data, crc)
                            if with_ids:
                                kept.append(data)
                        rows.append((doc_id, begin + place, n, crc, b"".join(kept))[:len(kinds)])
                        held += n if with_ids else 1
                        if held > 1_000_000 or len(rows) > 20_000:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    listed = files.select("path", "bytes", "start")
    return listed.repartition(max(1, files.count()), "path").mapInArrow(read, schema)
