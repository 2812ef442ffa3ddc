"""Best-fit packing of token sequences by large-item matching.

Documents become pieces of at most `capacity` tokens, written once with their
ids. What is packed is the histogram of piece lengths, at most `capacity`
numbers whatever the table's size: pieces of one length are interchangeable, so
a plan says how many bins of which make-up there are, and each piece finds its
place by its rank among the pieces of its length.

The plan: pieces above one third of the capacity, at most two to a bin, are
matched greedily, each with the largest partner that still fits. Smaller pieces
then go, longest first, into the bin whose gap fits them best.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.chunk_tokens import ChunkEncoder
from millrace.llm.common import written

CAPACITY = 2048
# Pieces of one length that are ranked together in one window group.
RANKED_TOGETHER = 10_000
BATCH_TOKENS = 500_000
# An Arrow table becomes a frame without Python workers, unlike a list of rows.
SLOT = pa.schema([(name, pa.int64()) for name in ("length", "first_rank", "end_rank", "per_bin", "first_bin", "slot_offset")])


def token_pieces(df: DataFrame, id_column: str, text_column: str, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """Per piece: doc_id, piece, start, length and its ids as little-endian 32-bit binary.

    A document is its text's ids and one `end_id`; a null text is an empty one.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ChunkEncoder(tokenizer, keeps_blanks=False)
        rows: list[tuple] = []
        held = 0
        for batch in batches:
            texts = (t.as_py() for t in batch.column(1))
            for doc, ids in zip(batch.column(0).to_pylist(), encoder.encode_all(texts), strict=True):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for k, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start:start + capacity]
                    rows.append((doc, k, start, len(part), part.tobytes()))
                held += len(ids)
                if held >= BATCH_TOKENS:
                    yield _batch(rows)
                    rows, held = [], 0
        if rows:
            yield _batch(rows)

    plain = df.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text_column}`").alias("text"))
    return plain.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids binary")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    kinds = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.values(), strict=True)], names=list(kinds))


@dataclass
class Plan:
    """Where pieces go. A slot takes, of one length, the pieces ranked from
    `first_rank` on: `per_bin` side by side in each of `bins` bins."""

    capacity: int
    left: dict[int, int]
    bins: int = 0
    slots: list[tuple] = field(default_factory=list)
    gaps: dict[int, list[tuple[int, int]]] = field(default_factory=dict)
    ranked: dict[int, int] = field(default_factory=dict)

    def place(self, length: int, bins: tuple[int, int], per_bin: int, offset: int, count: int) -> None:
        rank = self.ranked.get(length, 0)
        self.slots.append((length, rank, rank + count, per_bin, bins[0], offset))
        self.ranked[length] = rank + count
        self.left[length] -= count

    def open(self, count: int) -> tuple[int, int]:
        self.bins += count
        return self.bins - count, count

    def add_gap(self, bins: tuple[int, int], gap: int) -> None:
        if gap > 0 and bins[1] > 0:
            self.gaps.setdefault(gap, []).append(bins)


def pack_lengths(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """The plan for pieces counted by length. Its size depends on the capacity, not on the counts."""
    plan = Plan(capacity, {n: c for n, c in counts.items() if c})
    if any(not 0 < n <= capacity for n in plan.left):
        raise ValueError("a piece is empty or longer than the capacity")
    large = sorted(n for n in plan.left if 3 * n > capacity)
    for length in reversed(list(large)):
        while plan.left[length]:
            k = bisect.bisect_right(large, min(length, capacity - length)) - 1
            while k >= 0 and plan.left[large[k]] < 1 + (large[k] == length):
                k -= 1
            if k < 0:
                bins = plan.open(plan.left[length])
                plan.place(length, bins, 1, 0, bins[1])
                plan.add_gap(bins, capacity - length)
                break
            partner = large[k]
            if partner == length:
                bins = plan.open(plan.left[length] // 2)
                plan.place(length, bins, 2, 0, 2 * bins[1])
            else:
                bins = plan.open(min(plan.left[length], plan.left[partner]))
                plan.place(length, bins, 1, 0, bins[1])
                plan.place(partner, bins, 1, length, bins[1])
            plan.add_gap(bins, capacity - length - partner)
    for length in sorted((n for n in plan.left if 3 * n <= capacity), reverse=True):
        while left := plan.left[length]:
            gap = min((g for g in plan.gaps if g >= length), default=0)
            if not gap:
                gap = capacity
                plan.add_gap(plan.open(-(-left // (capacity // length))), capacity)
            first, count = plan.gaps[gap].pop()
            if not plan.gaps[gap]:
                del plan.gaps[gap]
            per_bin = min(gap // length, left)
            full = min(count, left // per_bin)
            plan.place(length, (first, full), per_bin, capacity - gap, per_bin * full)
            plan.add_gap((first, full), gap - per_bin * length)
            plan.add_gap((first + full, count - full), gap)
    return plan


class PackedCorpus:
    """Documents packed into sequences of at most `capacity` tokens.

    `pieces` is a stored table of all pieces with their ids; `placed()` says
    where each lies, `sequences()` gives the packed sequences themselves. Every
    row is a document of its own, also when ids are null or repeat; null and
    empty texts are documents of one token; an empty table gives no sequence.
    Columns besides id and text are not read.
    """

    def __init__(self, df: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text", capacity: int = CAPACITY, end_id: int = 0):
        cut = token_pieces(df, id_column, text_column, tokenizer, capacity, end_id)
        self.capacity = capacity
        self.pieces = written(cut.withColumn("ids_crc32", F.crc32("ids")), "pieces")
        self.counts = {r["length"]: r["n"] for r in self.pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
        self.plan = pack_lengths(self.counts, capacity)

    def placed(self, *also: str) -> DataFrame:
        """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset and the columns `also`."""
        spark = self.pieces.sparkSession
        parts = max(1, -(-max(self.counts.values(), default=1) // RANKED_TOGETHER))
        rows = self.pieces.select("doc_id", "piece", "start", "length", "ids_crc32", *also)
        rows = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(parts)))
        # Equal rows of one part are told apart by nothing but their rank, so any order of them is right.
        ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")) - 1)
        sizes = rows.groupBy("length", "part").agg(F.count("*").alias("n"))
        earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        before = sizes.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
        ranked = ranked.join(before, ["length", "part"]).withColumn("rank", F.col("rank") + F.col("before"))
        slots = spark.createDataFrame(pa.Table.from_pylist([dict(zip(SLOT.names, s, strict=True)) for s in self.plan.slots], schema=SLOT))
        inside = F.col("rank") - F.col("first_rank")
        return (
            ranked.alias("r").join(F.broadcast(slots).alias("s"), (F.col("r.length") == F.col("s.length")) & (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("end_rank")))
            .select(
                "doc_id", "piece", "start", F.col("r.length").alias("length"), "ids_crc32",
                (F.col("first_bin") + F.floor(inside / F.col("per_bin")).cast("long")).alias("sequence_id"),
                (F.col("slot_offset") + F.pmod(inside, F.col("per_bin")) * F.col("r.length")).alias("offset"), *also,
            )
        )

    def sequences(self) -> DataFrame:
        """Per sequence: sequence_id, n_tokens, its documents in order, and its ids as binary."""
        parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "length", "ids")))
        return (
            self.placed("ids").groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("parts"))
            .select("sequence_id", "n_tokens", F.col("parts.doc_id").alias("doc_ids"), F.unhex(F.array_join(F.transform("parts", lambda p: F.hex(p["ids"])), "")).alias("ids"))
        )
