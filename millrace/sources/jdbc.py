"""Database tables over JDBC; the driver jar is the user's to provide."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    low: int,
    high: int,
    n: int,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """A table read by `n` tasks, each a range of a numeric column.

    `low` and `high` only set the ranges; rows outside them are read too.
    """
    return spark.read.jdbc(url, table, column, low, high, n, properties=dict(properties or {}))


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "overwrite", connections: int = 8,
               properties: Mapping[str, str] | None = None) -> None:
    """Write with at most `connections` tasks at a time, to spare the database."""
    df.coalesce(connections).write.jdbc(url, table, mode, properties=dict(properties or {}))
