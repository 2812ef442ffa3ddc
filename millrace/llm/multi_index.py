"""Near-duplicate vectors by an inverted multi-index.

Each half of the unit vectors gets a codebook of its own; the product of both is
a grid of cells, and every vector lies in one. A vector visits cells in the order
of its distance to them (multi-sequence order over both sorted codebooks) up to a
margin, and is compared there with the cell's vectors in double precision. The
margin is set on a sample: among sampled vectors and partners drawn at exactly
the threshold, a share of `target_recall` must have one visit the other's cell.
Closer partners are found more often than that.

Only vectors of equal label and length meet. Equal vectors are one class, so
copies are never compared with each other. Cells are read as streams: a bounded
chunk of residents in memory, visitors in batches; what comes out is link counts
and a spanning forest of the links, never the pairs themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from millrace.llm.common import written
from millrace.llm.components import components

# Most vectors, and most bytes of them, of the sample that codebooks and margin are fitted on.
SAMPLE_ROWS = 20_000
SAMPLE_BYTES = 32 << 20
LEAST_PARTNERS = 20_000
CELL_ROWS = 256
MOST_CODES = 256
# Residents of a cell that one task holds at a time, and visitors compared at once.
CHUNK_ROWS = 4096
VISITORS = 512


def prepared(df: DataFrame, id_column: str, vector_column: str, label_column: str) -> DataFrame:
    """Per row: vec_id, label, dim, a key that vectors of equal direction share, and the components as they
    came (4 bytes each where they were floats); the last three are null for vectors that link with nothing."""
    width = _width(df, vector_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for vec_id, label, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                raw = given = None
                if vec_id is not None and label is not None and vector.is_valid and not vector.values.null_count and len(vector.values):
                    given = vector.values.to_numpy(zero_copy_only=False) + 0.0
                    raw = given
                    size = np.abs(raw).max()
                    raw = raw / size if np.isfinite(raw).all() and size > 0 else None
                if raw is None:
                    rows.append((vec_id, label, None, None, None))
                else:
                    unit = raw / np.sqrt(raw @ raw)
                    rows.append((vec_id, label, len(unit), xxhash.xxh3_128_digest(unit.tobytes()), given.astype(width).tobytes()))
            kinds = (pa.int64(), pa.string(), pa.int32(), pa.binary(), pa.binary())
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["vec_id", "label", "dim", "key", "raw"])

    plain = df.select(F.col(f"`{id_column}`").cast("long"), F.col(f"`{label_column}`").cast("string"), F.col(f"`{vector_column}`").cast("array<double>"))
    return plain.toDF("vec_id", "label", "vector").mapInArrow(run, "vec_id long, label string, dim int, key binary, raw binary")


def _width(df: DataFrame, vector_column: str) -> str:
    kind = df.schema[vector_column].dataType
    return "<f4" if isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType) else "<f8"


def units(raw: list[bytes], width: str) -> np.ndarray:
    """Unit vectors, in double precision, of components as `prepared` gives them."""
    x = np.array([np.frombuffer(r, width) for r in raw]).astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def squared_distances(x: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ codes.T + (codes * codes).sum(1)[None, :], 0)


def codebook(x: np.ndarray, k: int, seed: int, rounds: int = 10) -> np.ndarray:
    """Centroids of at most `k` clusters of the rows of `x` (Lloyd's iterations)."""
    rng = np.random.default_rng(seed)
    distinct = np.unique(x, axis=0)
    codes = distinct[rng.permutation(len(distinct))[:k]]
    for _ in range(rounds):
        nearest = squared_distances(x, codes).argmin(1)
        for c in range(len(codes)):
            if (mine := nearest == c).any():
                codes[c] = x[mine].mean(0)
    return codes


class Grid:
    """The two codebooks and the margin up to which cells are visited."""

    def __init__(self, sample: np.ndarray, codes: int, threshold: float, target_recall: float, seed: int = 5):
        self.half = sample.shape[1] // 2
        self.books = [codebook(part, codes, seed + k) for k, part in enumerate(self.split(sample))]
        rng = np.random.default_rng(seed)
        # Several partners of each vector where the sample is small.
        sample = np.tile(sample, (-(-LEAST_PARTNERS // len(sample)), 1))
        noise = rng.normal(size=sample.shape)
        noise -= (noise * sample).sum(1, keepdims=True) * sample
        noise /= np.maximum(np.sqrt((noise * noise).sum(1, keepdims=True)), 1e-300)
        partner = threshold * sample + np.sqrt(max(0.0, 1 - threshold**2)) * noise
        there, back = self.excess(sample), self.excess(partner)
        needed = np.minimum(self.cost(there, self.cells(back)), self.cost(back, self.cells(there)))
        self.margin = float(np.quantile(needed, target_recall)) + 1e-9

    def split(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x[:, :self.half], x[:, self.half:]

    def excess(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per half: squared distance to each code, beyond that to the nearest."""
        out = [squared_distances(part, book) for part, book in zip(self.split(x), self.books, strict=True)]
        return tuple(d - d.min(1, keepdims=True) for d in out)

    @staticmethod
    def cells(excess: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return excess[0].argmin(1), excess[1].argmin(1)

    @staticmethod
    def cost(excess: tuple[np.ndarray, np.ndarray], cells: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        rows = np.arange(len(cells[0]))
        return excess[0][rows, cells[0]] + excess[1][rows, cells[1]]

    def visits(self, excess: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, first code, second code) of all cells within the margin, by walking both sorted code lists."""
        order = [np.argsort(e, axis=1, kind="stable") for e in excess]
        near = [np.take_along_axis(e, o, 1) for e, o in zip(excess, order, strict=True)]
        rows, firsts, seconds = [], [], []
        for a in range(near[0].shape[1]):
            for b in range(near[1].shape[1]):
                reach = np.flatnonzero(near[0][:, a] + near[1][:, b] <= self.margin)
                if not len(reach):
                    break
                rows.append(reach)
                firsts.append(order[0][reach, a])
                seconds.append(order[1][reach, b])
            if not (near[0][:, a] <= self.margin).any():
                break
        return np.concatenate(rows), np.concatenate(firsts), np.concatenate(seconds)


class Forest:
    """Union-find over a chunk's residents, fed with batches of (visitor, resident) links."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self) -> np.ndarray:
        while (self.parent != (up := self.parent[self.parent])).any():
            self.parent = up
        return self.parent

    def join(self, visitor: np.ndarray, resident: np.ndarray) -> None:
        """Residents that share a visitor get one root."""
        while True:
            root = self.roots()[resident]
            least = np.full(visitor.max() + 1, len(self.parent))
            np.minimum.at(least, visitor, root)
            if (root == least[visitor]).all():
                return
            parent = self.parent.copy()
            np.minimum.at(parent, root, least[visitor])
            self.parent = parent


def _scan(grid, threshold: float, width: str):
    """Task code: residents of a chunk come first, then its visitors."""
    schema = ["kind", "a", "b"]

    def emit(rows: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        kinds = np.concatenate([np.full(len(a), k) for k, a, _ in rows])
        return pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in (kinds, np.concatenate([a for _, a, _ in rows]), np.concatenate([b for _, _, b in rows]))], names=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g: Grid = grid.value
        key, held, visiting = None, [], False
        x = nodes = copies = excess = cells = links = forest = None

        def close() -> list[tuple[int, np.ndarray, np.ndarray]]:
            if not visiting:
                return []
            root = forest.roots()
            tied = np.flatnonzero(root != np.arange(len(root)))
            some = np.flatnonzero(links)
            return [(0, nodes[some], links[some]), (1, nodes[tied], nodes[root[tied]])]

        for batch in batches:
            names = [batch.column(k).to_pylist() for k in range(5)]
            keys = list(zip(*names, strict=True))
            ids, counts = batch.column(5).to_numpy(), batch.column(6).to_numpy()
            raw, kinds = batch.column(7).to_pylist(), batch.column(8).to_numpy()
            out: list[tuple[int, np.ndarray, np.ndarray]] = []
            begin = 0
            while begin < len(keys):
                end = begin + 1
                while end < len(keys) and end - begin < VISITORS and keys[end] == keys[begin] and kinds[end] == kinds[begin]:
                    end += 1
                vectors = units(raw[begin:end], width)
                if keys[begin] != key:
                    out += close()
                    key, held, visiting = keys[begin], [], False
                if kinds[begin] == 0:
                    held.append((vectors, ids[begin:end], counts[begin:end]))
                elif held:
                    if not visiting:
                        x, nodes, copies = (np.concatenate(part) for part in zip(*held, strict=True))
                        excess = g.excess(x)
                        cells, links, forest, visiting = g.cells(excess), np.zeros(len(x), np.int64), Forest(len(x)), True
                    mine, theirs = ids[begin:end], g.cells(g.excess(vectors))
                    # A resident that visits the visitor's cell meets it there as well: such a pair counts once, from the smaller id.
                    mutual = excess[0][:, theirs[0]].T + excess[1][:, theirs[1]].T <= g.margin
                    linked = (vectors @ x.T >= threshold) & (mine[:, None] != nodes[None, :]) & (~mutual | (mine[:, None] < nodes[None, :]))
                    q, r = np.nonzero(linked)
                    if len(q):
                        links += linked.T @ counts[begin:end]
                        who, first = np.unique(q, return_index=True)
                        out += [(0, mine[who], (linked[who] @ copies)), (1, mine[who], nodes[r[first]])]
                        forest.join(q, r)
                begin = end
            if out := [o for o in out if len(o[1])]:
                yield emit(out)
        if out := [o for o in close() if len(o[1])]:
            yield emit(out)

    return run


class VectorLinks:
    """Links between vectors of equal label with cosine >= `threshold`.

    Null labels, and vectors that are null, empty, zero or hold null or
    non-finite numbers, link with nothing; nor do rows without an id. Repeated
    rows are vectors of their own and link with each other. Other columns are
    not read; an empty table gives an empty result.
    """

    def __init__(self, df: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label", threshold: float = 0.93, target_recall: float = 0.9999):
        self.threshold, self.target_recall, self.width = threshold, target_recall, _width(df, vector_column)
        self.rows = written(prepared(df, id_column, vector_column, label_column), "vectors")
        valid = self.rows.where(F.col("key").isNotNull())
        grouped = valid.groupBy("label", "dim", "key").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"), F.first("raw").alias("raw"))
        self.classes = written(grouped, "classes")
        self.grids: dict[int, Grid] = {}
        found = None
        for row in self.classes.groupBy("dim").agg(F.count("*").alias("n")).collect():
            part = self._compared(row["dim"], row["n"])
            found = part if found is None else found.unionByName(part)
        empty = df.sparkSession.createDataFrame([], "kind long, a long, b long")
        self.found = written(empty if found is None else found, "found")

    def _compared(self, dim: int, n: int) -> DataFrame:
        rows = self.classes.where(F.col("dim") == dim)
        most = max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * dim)))
        some = rows.select("raw").sample(min(1.0, 1.2 * most / n), seed=11).limit(most).collect() or rows.select("raw").limit(1).collect()
        codes = int(min(MOST_CODES, max(4, np.ceil(np.sqrt(n / CELL_ROWS)))))
        grid = self.grids[dim] = Grid(units([r["raw"] for r in some], self.width), codes, self.threshold, self.target_recall)
        shared, width = rows.sparkSession.sparkContext.broadcast(grid), self.width

        def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            g: Grid = shared.value
            for batch in batches:
                for begin in range(0, batch.num_rows, 2048):
                    part = batch.slice(begin, 2048)
                    excess = g.excess(units(part.column(3).to_pylist(), width))
                    first, second = g.cells(excess)
                    row, i, j = g.visits(excess)
                    kinds = np.concatenate([np.zeros(len(first), np.int64), np.ones(len(row), np.int64)])
                    took = part.take(pa.array(np.concatenate([np.arange(len(first)), row])))
                    codes_of = [pa.array(np.concatenate(c), pa.int32()) for c in ((first, i), (second, j))]
                    yield pa.RecordBatch.from_arrays([took.column(0), *codes_of, *took.columns[1:], pa.array(kinds)], names=["label", "i", "j", "node", "copies", "raw", "kind"])

        placed = rows.select("label", "node", "copies", "raw").mapInArrow(visit, "label string, i int, j int, node long, copies long, raw binary, kind long")
        placed = written(placed, "placed")
        cell = ["label", "i", "j"]
        residents = placed.where(F.col("kind") == 0)
        sizes = residents.groupBy(*cell).agg(F.ceil(F.count("*") / CHUNK_ROWS).alias("chunks"))
        met = placed.join(sizes, cell)
        own = F.array(F.pmod(F.xxhash64("node"), F.col("chunks")))
        met = met.withColumn("chunk", F.explode(F.when(F.col("kind") == 0, own).otherwise(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))))
        ordered = met.select(*cell, "chunk", F.lit(dim).alias("dim"), "node", "copies", "raw", "kind")
        parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        dealt = ordered.repartition(parts, *cell, "chunk").sortWithinPartitions(*cell, "chunk", "kind")
        return dealt.mapInArrow(_scan(shared, self.threshold, width), "kind long, a long, b long")

    def vectors(self) -> DataFrame:
        """One row per input row: vec_id, n_links, component_id, kept."""
        counts = self.found.where(F.col("kind") == 0).groupBy(F.col("a").alias("node")).agg(F.sum("b").alias("n"))
        labels = components(self.found.where(F.col("kind") == 1).select("a", "b"))
        known = (
            self.classes.join(counts, "node", "left").join(labels, "node", "left")
            .select("label", "dim", "key", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("component", "node").alias("component"))
        )
        joined = self.rows.drop("raw").join(known, ["label", "dim", "key"], "left")
        component = F.coalesce("component", "vec_id")
        return joined.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))
