"""Nearest neighbours by randomly rotated one-bit codes.

A unit vector o is padded with zeros to D components and rotated (random signs
and Hadamard transforms); its code is the signs of the result, D packed bits, and
its correction scalar the alignment a = <o', sign(o') / sqrt(D)>. For a rotated
unit query q', <sign(o') / sqrt(D), q'> / a estimates <o, q> without bias, with
an error of about sqrt((1 - a^2) / a^2 / (D - 1)). A vector is reranked, that is,
compared with the query in double precision, when its estimate plus `bound` such
errors reaches the query's k-th best exact score so far.

Every row is indexed. A search is made of tiles, each a block of queries against
one file of the index, streamed past it; the tiles are read from the shared
folder, so neither side is shuffled or sent to all executors. Rows are dealt into
levels by hash, the first small and each further one LEVEL_GROWTH times as many:
what a level finds sets the score that later ones must reach, so tiles return few
rows however large the table is.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from millrace.llm.common import written
from millrace.llm.warc import opened
from millrace.session import shared_path

LEAST_BITS = 256
ROTATIONS = 3
# Most rows and bytes of the sample whose exact scores a query has to beat from the start.
SAMPLE_ROWS = 4096
SAMPLE_BYTES = 16 << 20
FIRST_LEVEL = 1 << 18
LEVEL_GROWTH = 64
# Queries of a block, index rows read at once, queries multiplied at once, and pairs reranked at once.
BLOCK_QUERIES = 4096
CHUNK_ROWS = 8192
CHUNK_QUERIES = 512
RERANKED = 32_768
CODED_ROWS = 1024


def code_bits(dim: int) -> int:
    """Bits of a code: a power of two, one per component at least."""
    return max(LEAST_BITS, 1 << (dim - 1).bit_length())


def rotated(x: np.ndarray, seed: int = 1) -> np.ndarray:
    """The rows of `x`, padded to code_bits components and rotated."""
    n, dim = x.shape
    size = code_bits(dim)
    y = np.zeros((n, size), np.float32)
    y[:, :dim] = x
    for k in range(ROTATIONS):
        y *= np.random.default_rng((seed, k, size)).choice(np.float32([-1, 1]), size)
        step = 1
        while step < size:
            z = y.reshape(n, size // (2 * step), 2, step)
            y = np.stack([z[:, :, 0] + z[:, :, 1], z[:, :, 0] - z[:, :, 1]], axis=2).reshape(n, size)
            step *= 2
        y *= np.float32(1 / math.sqrt(size))
    return y


def in_order(products: np.ndarray) -> np.ndarray:
    """Row sums, added from the first component to the last."""
    total = np.zeros(len(products))
    for column in products.T:
        total += column
    return total


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows whose squares might overflow or vanish, times a power of two, which keeps every digit."""
    most = np.abs(x).max(1)
    odd = np.flatnonzero((most > 1e100) | (most < 1e-100))
    x[odd] = np.ldexp(x[odd], -np.frexp(most[odd])[1][:, None])
    return x


def encoded(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(packed codes, alignments) of unit vectors."""
    y = rotated(x)
    return np.packbits(y >= 0, axis=1), np.abs(y).sum(1) / math.sqrt(y.shape[1])


def estimates(codes: np.ndarray, alignment: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes x queries estimates of the inner products, error of one bound per code)."""
    size = queries.shape[1]
    bits = np.unpackbits(codes, axis=1).astype(np.float32)
    est = bits @ (queries.T * np.float32(2 / math.sqrt(size)))
    est -= queries.sum(1) / np.float32(math.sqrt(size))
    est /= alignment[:, None]
    return est, np.sqrt(np.maximum(1 - alignment**2, 0)) / alignment / math.sqrt(size - 1)


def _usable(vector: pa.ListScalar) -> np.ndarray | None:
    """The vector in double precision, or None where it can't be compared."""
    if not vector.is_valid or not len(vector.values) or vector.values.null_count:
        return None
    x = vector.values.to_numpy(zero_copy_only=False).astype(np.float64)
    return x if np.isfinite(x).all() and np.any(x) else None


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin in range(0, batch.num_rows, CODED_ROWS):
            yield batch.slice(begin, CODED_ROWS)


def _groups(dims: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    for dim in np.unique(dims):
        yield int(dim), np.flatnonzero(dims == dim)


def _vectors(column: pa.Array, rows: np.ndarray, width: str) -> np.ndarray:
    return scaled(np.stack([np.frombuffer(v, width) for v in column.take(pa.array(rows)).to_pylist()]).astype(np.float64))


class _Best:
    """The k best (score, id) of each query of a block; ties to the smaller id."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score, self.id = np.full((n, k), -np.inf), np.zeros((n, k), np.int64)

    def add(self, q: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        mine = np.unique(q)
        held = self.score[mine] > -np.inf
        q = np.concatenate([q, np.repeat(mine, held.sum(1))])
        score, ids = np.concatenate([score, self.score[mine][held]]), np.concatenate([ids, self.id[mine][held]])
        order = np.lexsort((ids, -score, q))
        q, score, ids = q[order], score[order], ids[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        keep = place < self.k
        self.score[mine] = -np.inf
        self.score[q[keep], place[keep]], self.id[q[keep], place[keep]] = score[keep], ids[keep]


def _tiles(k: int, bound: float, width: str, query_width: str):
    """Task code: rows (index file, file of queries) to rows (q, vec_id, score)."""

    def tile(index_file: str, query_file: str) -> Iterator[pa.RecordBatch]:
        fs, inside = opened(query_file)
        block = pq.read_table(fs.open_input_file(inside)).combine_chunks()
        names, own, floors, dims = (block[c].to_numpy() for c in ("q", "query_id", "floor", "dim"))
        # Per length: queries, their rotations and vectors; a query's threshold rises with what it finds.
        sides = {}
        for dim, rows in _groups(dims):
            vectors = _vectors(block["vector"].chunk(0), rows, query_width)
            norms = np.sqrt(in_order(vectors * vectors))
            sides[dim] = (rows, rotated(vectors / norms[:, None]), vectors, norms)
        reach, best = floors.copy(), _Best(len(names), k)
        fs, inside = opened(index_file)
        with fs.open_input_file(inside) as file:
            for batch in pq.ParquetFile(file).iter_batches(CHUNK_ROWS):
                ids = batch["vec_id"].to_numpy()
                for dim, rows in _groups(batch["dim"].to_numpy()):
                    if dim not in sides:
                        continue
                    codes = np.frombuffer(b"".join(batch["code"].take(pa.array(rows)).to_pylist()), np.uint8).reshape(len(rows), -1)
                    alignment = batch["alignment"].to_numpy()[rows].astype(np.float32)
                    vectors = _vectors(batch["vector"], rows, width)
                    norms, mine = np.sqrt(in_order(vectors * vectors)), ids[rows]
                    held, turned, wanted, sizes = sides[dim]
                    for begin in range(0, len(held), CHUNK_QUERIES):
                        q = held[begin:begin + CHUNK_QUERIES]
                        est, error = estimates(codes, alignment, turned[begin:begin + CHUNK_QUERIES])
                        # Sums in single precision are off by far less than 1e-5.
                        est += (bound * error + 1e-5)[:, None]
                        near = np.flatnonzero((est >= reach[q]) & (mine[:, None] != own[q]))
                        for start in range(0, len(near), RERANKED):
                            v, w = np.divmod(near[start:start + RERANKED], len(q))
                            score = in_order(vectors[v] * wanted[begin + w]) / (norms[v] * sizes[begin + w])
                            good = score >= reach[q[w]]
                            if good.any():
                                best.add(q[w[good]], score[good], mine[v[good]])
                                reach[q] = np.maximum(reach[q], best.score[q, k - 1])
        which, place = np.nonzero(best.score > -np.inf)
        if len(which):
            yield pa.RecordBatch.from_arrays([pa.array(names[which]), pa.array(best.id[which, place]), pa.array(best.score[which, place])], names=["q", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for index_file, query_file in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                yield from tile(index_file, query_file)

    return run


def _width(df: DataFrame, column: str) -> str:
    kind = df.schema[column].dataType
    return "<f4" if isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType) else "<f8"


class OneBitIndex:
    """An index over all vectors of `df`, kept in the shared folder.

    Vectors that are null, empty, zero or hold null or non-finite numbers, and
    rows without an id, take no part; nor do vectors of different lengths meet.
    Repeated rows are candidates of their own. Other columns are not read; an
    empty table is an empty index.
    """

    def __init__(self, df: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding"):
        self.spark, self.width = df.sparkSession, _width(df, vector_column)
        plain = df.select(F.col(f"`{id_column}`").cast("long").alias("vec_id"), F.col(f"`{vector_column}`").alias("vector"))
        rows = plain.count()
        self.levels = 1 + max(0, math.ceil(math.log(max(rows, 1) / FIRST_LEVEL, LEVEL_GROWTH)))
        shares = [min(1.0, FIRST_LEVEL * LEVEL_GROWTH**k / max(rows, 1)) for k in range(self.levels)]
        width = self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _parts(batches):
                usable = [None if i is None else _usable(v) for i, v in zip(batch.column(0).to_pylist(), batch.column(1), strict=True)]
                dims = np.array([0 if x is None else len(x) for x in usable], np.int32)
                for dim, rows in _groups(dims):
                    if dim:
                        x = scaled(np.stack([usable[r] for r in rows]))
                        codes, alignment = encoded(x / np.sqrt((x * x).sum(1, keepdims=True)))
                        parts = [
                            batch.column(0).take(pa.array(rows)), pa.array(np.full(len(rows), dim, np.int32)), pa.array([c.tobytes() for c in codes], pa.binary()),
                            pa.array(alignment.astype(np.float32)), pa.array([usable[r].astype(width).tobytes() for r in rows], pa.binary()),
                        ]
                        yield pa.RecordBatch.from_arrays(parts, names=["vec_id", "dim", "code", "alignment", "vector"])

        coded = plain.mapInArrow(run, "vec_id long, dim int, code binary, alignment float, vector binary")
        # Levels by a hash of the row, so that each is a fair sample of all.
        draw = F.pmod(F.xxhash64("vec_id", "code"), F.lit(1 << 30)) / float(1 << 30)
        level = F.lit(self.levels - 1)
        for k in reversed(range(self.levels - 1)):
            level = F.when(draw < shares[k], k).otherwise(level)
        self.path = shared_path(self.spark, "one-bit")
        coded.withColumn("level", level).write.partitionBy("level").option("compression", "zstd").parquet(self.path)
        self.rows = self.spark.read.schema(f"{coded.schema.simpleString()[7:-1].replace(':', ' ')}, level int").parquet(self.path)

    def _sample(self) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """Per length: ids and unit vectors of a bounded sample of the first level."""
        first = self.rows.where("level = 0").select("vec_id", "dim", "vector")
        size = first.agg(F.count("*"), F.max(F.octet_length("vector"))).first()
        if not size[0]:
            return {}
        most = int(max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // size[1])))
        got = first.sample(min(1.0, 1.2 * most / size[0]), seed=3).limit(most).collect()
        out = {}
        for dim, rows in _groups(np.array([r["dim"] for r in got])):
            x = scaled(np.stack([np.frombuffer(got[r]["vector"], self.width) for r in rows]).astype(np.float64))
            out[dim] = (np.array([got[r]["vec_id"] for r in rows]), x / np.sqrt((x * x).sum(1, keepdims=True)))
        return out

    def _queries(self, df: DataFrame, id_column: str, vector_column: str, k: int) -> DataFrame:
        """q (a number of its own), query_id, dim, vector, and floor: a score that the k-th best reaches for sure."""
        sample = self.spark.sparkContext.broadcast(self._sample())
        width = _width(df, vector_column)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _parts(batches):
                usable = [None if i is None else _usable(v) for i, v in zip(batch.column(1).to_pylist(), batch.column(2), strict=True)]
                for dim, rows in _groups(np.array([0 if x is None else len(x) for x in usable], np.int32)):
                    if not dim:
                        continue
                    x = scaled(np.stack([usable[r] for r in rows]))
                    own, floor = batch.column(1).to_numpy(zero_copy_only=False)[rows].astype(np.int64), np.full(len(rows), -np.inf)
                    ids, known = sample.value.get(dim, (None, None))
                    if ids is not None and len(ids) >= k:
                        for begin in range(0, len(rows), CHUNK_QUERIES):
                            part = slice(begin, begin + CHUNK_QUERIES)
                            score = (x[part] / np.sqrt((x[part] * x[part]).sum(1, keepdims=True))) @ known.T
                            score[own[part, None] == ids] = -np.inf
                            floor[part] = np.partition(score, len(ids) - k, axis=1)[:, len(ids) - k] - 1e-9
                    vectors = pa.array([usable[r].astype(width).tobytes() for r in rows], pa.binary())
                    parts = [batch.column(0).take(pa.array(rows)), pa.array(own), pa.array(np.full(len(rows), dim, np.int32)), vectors, pa.array(floor)]
                    yield pa.RecordBatch.from_arrays(parts, names=["q", "query_id", "dim", "vector", "floor"])

        plain = df.select(F.monotonically_increasing_id().alias("q"), F.col(f"`{id_column}`").cast("long").alias("query_id"), F.col(f"`{vector_column}`").alias("vector"))
        return written(plain.mapInArrow(run, "q long, query_id long, dim int, vector binary, floor double"), "queries")

    def search(self, queries: DataFrame, k: int = 5, id_column: str = "vec_id", vector_column: str = "embedding", bound: float = 4.0) -> DataFrame:
        """Per query row: query_id, rank (from 1), vec_id and score (cosine) of the k nearest found, ties to the smaller id.

        Rows of the query's own id are no candidates. Queries that can't be
        compared (see the class) have no rows; where there are fewer than k
        candidates, all are returned. With `bound` standard errors of 4 about
        one true neighbour in ten thousand at the k-th score is missed. Adding a
        query's products from the first component to the last, scores are the
        same on every machine.
        """
        asked = self._queries(queries, id_column, vector_column, k)
        blocks = 1 + asked.count() // BLOCK_QUERIES
        width, query_width = self.width, _width(queries, vector_column)
        order = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
        best = self.spark.createDataFrame([], "q long, vec_id long, score double")
        for level in range(self.levels):
            least = best.groupBy("q").agg(F.when(F.count("*") == k, F.min("score")).alias("least"))
            path = shared_path(self.spark, "blocks")
            # A query's number is its own, so no key of this shuffle is hot.
            rising = asked.join(least, "q", "left").withColumn("floor", F.greatest("floor", F.coalesce("least", F.lit(float("-inf"))))).drop("least")
            rising.repartition(blocks, "q").write.option("maxRecordsPerFile", BLOCK_QUERIES).parquet(path)
            block_files = self.spark.read.schema(asked.schema).parquet(path).select(F.col("_metadata.file_path").alias("block")).distinct()
            names = [r["block"] for r in block_files.collect()]
            files = self.rows.where(F.col("level") == level).select(F.col("_metadata.file_path").alias("file")).distinct()
            # One name per BLOCK_QUERIES queries: tiles pair files, not rows.
            tiles = files.withColumn("block", F.explode(F.lit(names) if names else F.array().cast("array<string>")))
            count = max(1, min(files.count() * len(names), 100_000))
            found = tiles.repartition(count).mapInArrow(_tiles(k, bound, width, query_width), best.schema)
            ranked = best.unionByName(found).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            best = written(ranked.drop("rank"), "nearest")
        ranked = best.withColumn("rank", F.row_number().over(order))
        return ranked.join(asked.select("q", "query_id"), "q").select("query_id", "rank", "vec_id", "score")
