"""Centroid clustering of integer vectors by a tournament of bisectors.

For centroids a < b, the nearer of the two to x is told by the sign of
`normal . x - threshold`, where normal = 2 (b - a) and threshold = |b|^2 - |a|^2:
positive means b, zero and negative a. Normals and thresholds of all pairs are
integers, computed once a round. A vector starts with centroid 0 and meets each
further centroid once, so k - 1 signs leave the nearest one, the smaller number
at ties; only its distance is then computed. Everything is exact: 64-bit
integers where the numbers fit, Python's own beyond that.

Rounds send per task one sum for each centroid and component; the driver holds k
centroids and nothing that grows with the rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import written

LONG_MAX = 2**63 - 1
# Sums leave a task in pieces of this many bits, so that adding them up can't overflow a long.
LIMB_BITS = 40
# Most bytes of the pairs' normals, which every task holds; k and the length of vectors are parameters.
MOST_NORMALS = 256 << 20


def whole(vectors: Column, dim: int) -> Column:
    """Whether a vector has `dim` components, none null or non-finite."""
    finite = F.forall(vectors, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vectors) == dim) & finite, F.lit(False))


def integers(values: np.ndarray, scale: int, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """(int64 matrix of floor(scale * x), rows whose numbers exceed `limit` and stand as zeros in it)."""
    with np.errstate(over="ignore"):
        scaled = np.floor(scale * values)
    wide = ~(np.abs(scaled) <= limit).all(1)
    scaled[wide] = 0
    return scaled.astype(np.int64), np.flatnonzero(wide)


def exact_integers(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as Python integers; a double of 2**53 or more is whole already."""
    return np.array([[int(v) * scale if abs(v) >= 2**53 else math.floor(scale * v) for v in row] for row in values.tolist()], dtype=object).reshape(values.shape)


class Tournament:
    """Normals and thresholds of all pairs of centroids."""

    def __init__(self, centroids: list[list[int]]):
        self.k, self.dim = len(centroids), len(centroids[0])
        if 4 * self.k * (self.k - 1) * self.dim > MOST_NORMALS:
            raise ValueError("the normals of so many centroids of this length don't fit a task")
        self.limit = math.isqrt(2**60 // self.dim)
        exact = np.array(centroids, dtype=object).reshape(self.k, self.dim)
        self.narrow = max(abs(c) for row in centroids for c in row) <= self.limit
        self.centroids = exact.astype(np.int64) if self.narrow else exact
        a, b = np.triu_indices(self.k, 1)
        squares = (self.centroids * self.centroids).sum(1)
        self.normals = 2 * (self.centroids[b] - self.centroids[a])
        self.thresholds = squares[b] - squares[a]
        # Pair (a, b) lies at start[a] + b.
        self.start = np.array([i * self.k - i * (i + 1) // 2 - i - 1 for i in range(self.k)])

    def winners(self, x: np.ndarray) -> np.ndarray:
        """Number of the nearest centroid of each row."""
        champion = np.zeros(len(x), np.int64)
        for challenger in range(1, self.k):
            pair = self.start[champion] + challenger
            if x.dtype == object or not self.narrow:
                side = (self.normals[pair] * x).sum(1) - self.thresholds[pair]
            else:
                side = np.einsum("ij,ij->i", self.normals[pair], x) - self.thresholds[pair]
            champion[(side > 0).astype(bool)] = challenger
        return champion

    def distances(self, x: np.ndarray, winner: np.ndarray) -> np.ndarray:
        apart = x - self.centroids[winner]
        return (apart * apart).sum(1)


def _matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(-1, dim)


def _matched(tournament: Tournament, values: np.ndarray, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row numbers, integer vectors, winners): first the rows that 64 bits hold, then the others."""
    x, wide = integers(values, scale, tournament.limit)
    if not tournament.narrow:
        wide = np.arange(len(values))
    rest = np.delete(np.arange(len(values)), wide)
    if len(rest):
        yield rest, x[rest], tournament.winners(x[rest])
    if len(wide):
        y = exact_integers(values[wide], scale)
        yield wide, y, tournament.winners(y)


def _limbs(value: int) -> list[int]:
    sign, value, out = (-1 if value < 0 else 1), abs(value), []
    while value:
        out.append(sign * (value & ((1 << LIMB_BITS) - 1)))
        value >>= LIMB_BITS
    return out


class BisectorClusters:
    """k clusters of the vectors that have `dim` components, none null or non-finite.

    A component x becomes the integer floor(scale * x). Centroids start as the
    kept vectors whose ids have the smallest SHA-256 of `seed:id` (fewer vectors
    than k: as many centroids), in that order; vectors of one id are taken by
    their components, those without an id last. Each round assigns all vectors
    to their nearest centroid, the smaller number at ties, and moves every
    centroid that has vectors to the floor of their mean. Repeated rows count
    each; other columns are not read. Squared distances and their sums beyond
    the largest long are given as that; assignments stay exact. Without kept
    vectors all results are empty. The input is read `rounds` + 2 times: store
    an expensive one first.
    """

    def __init__(self, df: DataFrame, k: int = 16, rounds: int = 3, dim: int = 64, scale: int = 64, seed: int = 1, id_column: str = "vec_id", vector_column: str = "embedding"):
        self.dim, self.scale = dim, scale
        plain = df.select(F.col(f"`{id_column}`").cast("long").alias("vec_id"), F.col(f"`{vector_column}`").cast("array<double>").alias("vector"))
        self.rows = plain.where(whole(F.col("vector"), dim))
        drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
        first = self.rows.orderBy(drawn.asc_nulls_last(), "vector").limit(k).collect()
        self.centroids = exact_integers(np.array([r["vector"] for r in first], float).reshape(-1, dim), scale).tolist()
        for _ in range(rounds if first else 0):
            self._move()

    def _move(self) -> None:
        tournament, dim, scale = Tournament(self.centroids), self.dim, self.scale

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            totals = np.zeros((tournament.k, dim), dtype=object)
            counts = np.zeros(tournament.k, np.int64)
            for batch in batches:
                for _, x, winner in _matched(tournament, _matrix(batch.column(0), dim), scale):
                    counts += np.bincount(winner, minlength=tournament.k)
                    for c in np.unique(winner):
                        totals[c] += x[winner == c].sum(0).astype(object)
            out = [(int(c), -1, 0, int(counts[c])) for c in np.flatnonzero(counts)]
            out += [(int(c), place, limb, part) for c in np.flatnonzero(counts) for place in range(dim) for limb, part in enumerate(_limbs(int(totals[c, place])))]
            if out:
                kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=["cluster", "place", "limb", "total"])

        sums = self.rows.select("vector").mapInArrow(run, "cluster int, place int, limb int, total long")
        found: dict[tuple[int, int], int] = {}
        for r in sums.groupBy("cluster", "place", "limb").agg(F.sum("total").alias("total")).collect():
            found[r["cluster"], r["place"]] = found.get((r["cluster"], r["place"]), 0) + (r["total"] << (LIMB_BITS * r["limb"]))
        for c in range(tournament.k):
            if n := found.get((c, -1)):
                self.centroids[c] = [found.get((c, place), 0) // n for place in range(dim)]

    def assigned(self) -> DataFrame:
        """vec_id, cluster and squared distance of every kept vector."""
        schema = "vec_id long, cluster int, distance long"
        if not self.centroids:
            return self.rows.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).limit(0)
        tournament, dim, scale = Tournament(self.centroids), self.dim, self.scale

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for rows, x, winner in _matched(tournament, _matrix(batch.column(1), dim), scale):
                    far = np.minimum(tournament.distances(x, winner), LONG_MAX).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pc.take(batch.column(0), pa.array(rows)), pa.array(winner, pa.int32()), pa.array(far)], names=["vec_id", "cluster", "distance"])

        return self.rows.mapInArrow(run, schema)

    def clusters(self) -> DataFrame:
        """Per kept vector: vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256."""
        found = written(self.assigned(), "assigned")
        capped = lambda total: F.least(total, F.lit(LONG_MAX).cast("decimal(38,0)")).cast("long")
        # At most k rows, also where they are added up.
        parts = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).cast("decimal(38,0)").alias("total"))
        whole_sum = parts.agg(F.sum("total").cast("decimal(38,0)").alias("all"))
        sums = parts.select("cluster", capped(F.col("total")).alias("cluster_inertia"), capped(whole_sum.scalar()).alias("inertia"))
        names = [(c, ",".join(map(str, row))) for c, row in enumerate(self.centroids)]
        hashes = found.sparkSession.createDataFrame(names, "cluster int, components string").select("cluster", F.sha2("components", 256).alias("centroid_sha256"))
        return found.join(F.broadcast(sums.join(hashes, "cluster")), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
