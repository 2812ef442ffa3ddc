"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import written

# Links that one task takes: most tables of links are small, and need no rounds at all.
LINKS_PER_TASK = 500_000


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _connected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, component) of a task's links: every label sinks to the smallest of its neighbours', then to that one's label."""
    held = pa.Table.from_batches(list(batches), pa.schema([("a", pa.int64()), ("b", pa.int64())]))
    nodes, at = np.unique(np.concatenate([held["a"].to_numpy(), held["b"].to_numpy()]), return_inverse=True)
    ends, label = at.reshape(2, -1), np.arange(len(nodes))
    while len((of := np.sort(label[ends], axis=0))[0]) and (of[0] != of[1]).any():
        np.minimum.at(label, of[1], of[0])
        while (label[label] != label).any():
            label = label[label]
    if len(nodes):
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[label])], names=["node", "component"])


def components(links: DataFrame, most: int = LINKS_PER_TASK) -> DataFrame:
    """(node, component) of every node in `links` (columns a and b, long); the component is its smallest node.

    Up to `most` links are one task's work. Beyond, each round hangs every node's larger neighbours under its smallest one
    (large star), then its smaller neighbours (small star), until each component
    is one star. Rounds are written to the shared folder; only two numbers per
    round reach the driver. Null ends and loops are ignored; without links the
    result is empty.
    """
    a, b = F.col("a"), F.col("b")
    edges = written(links.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")), "edges")
    if edges.count() <= most:
        return written(edges.coalesce(1).mapInArrow(_connected, "node long, component long"), "components")
    edges = written(edges.distinct(), "edges")
    state = _state(edges)
    while state[0]:
        tasks = 1 + state[0] // LINKS_PER_TASK
        both = edges.unionByName(edges.select(b.alias("a"), a.alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where(b > a).join(least, "a").select(b.alias("a"), F.col("m").alias("b")).where(a != b).distinct()
        large = written(large.coalesce(tasks), "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct(b.alias("a"), F.col("m").alias("b")), F.struct(a, F.col("m").alias("b")))).alias("e"))
        edges = written(small.select("e.a", "e.b").where(a != b).distinct().coalesce(tasks), "small-star")
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(a.alias("node"), b.alias("component")).unionByName(edges.select(b.alias("node"), b.alias("component"))).distinct()
