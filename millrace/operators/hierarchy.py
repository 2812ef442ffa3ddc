"""Trees given as child-to-parent edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import shared_path


def _roots(edges: DataFrame, node: str, parent: str, root) -> DataFrame:
    """Nodes whose parent is `root` (None: that have none), or that meet the condition `root`."""
    name = F.col(node).cast("string")
    return edges.where(root if isinstance(root, Column) else F.col(parent).eqNullSafe(F.lit(root))).select(
        F.col(node).alias("node"), F.lit(0).alias("level"), name.alias("path")
    )


def _children(frontier: DataFrame, edges: DataFrame, node: str, parent: str) -> DataFrame:
    f = frontier.select(F.col("node").alias("_up"), "level", "path")
    return f.join(edges.select(node, parent), F.col("_up") == F.col(parent)).select(
        F.col(node).alias("node"),
        (F.col("level") + 1).alias("level"),
        F.concat_ws("/", "path", F.col(node).cast("string")).alias("path"),
    )


def levels_fixed(edges: DataFrame, node: str, parent: str, root, depth: int) -> DataFrame:
    """Nodes of the first `depth` levels, one join per level, in one lazy plan."""
    frontier = _roots(edges, node, parent, root)
    found = frontier
    for _ in range(depth - 1):
        frontier = _children(frontier, edges, node, parent)
        found = found.unionByName(frontier)
    return found


def walk(edges: DataFrame, node: str, parent: str, root, max_depth: int = 10_000) -> DataFrame:
    """Every node reachable from the roots, with level and path. `root`: the value
    that stands in the parent column of roots, None included, or a condition.

    Each level is written to a table in the shared folder that the next one
    reads, so plans stay one join long, a lost executor costs at most the level
    in progress, and small levels are broadcast by their known size. Nodes seen
    before are left out of a level, which ends cycles.
    """
    spark = edges.sparkSession
    table = shared_path(spark, "levels")
    fresh = _roots(edges, node, parent, root).select("node", "path")
    schema = f"node {dict(fresh.dtypes)['node']}, path string, level int"
    for level in range(max_depth + 1):
        fresh.write.parquet(f"{table}/level={level}")
        found = spark.read.schema(schema).parquet(table).select("node", "level", "path")
        frontier = found.where(F.col("level") == level)
        if frontier.isEmpty():
            return found
        children = _children(frontier, edges, node, parent).join(found.select("node"), "node", "left_anti")
        # A node with several parents arrives once per parent; one path is kept.
        fresh = children.groupBy("node").agg(F.min("path").alias("path"))
    raise ValueError(f"the hierarchy is deeper than {max_depth} levels")


def walk_sql(spark: SparkSession, edges: DataFrame, node: str, parent: str, root: int) -> DataFrame:
    """The same as a recursive query, for trees of at most 100 levels.

    Spark's default limits (100 levels, 1,000,000 rows) make it raise, never
    return part of a tree; `walk` has no such limits.
    """
    return spark.sql(
        f"""
        WITH RECURSIVE reached (node, level, path) AS (
          SELECT {node}, 0, CAST({node} AS STRING) FROM {{edges}} WHERE {parent} = {{root}}
          UNION ALL
          SELECT e.{node}, r.level + 1, concat(r.path, '/', CAST(e.{node} AS STRING))
          FROM reached r JOIN {{edges}} e ON e.{parent} = r.node
        )
        SELECT node, level, path FROM reached
        """,
        edges=edges,
        root=root,
    )
