"""A table split by key hash, so that an upsert rewrites only the parts it touches.

It is a `VersionedTable`: an upsert shows whole or not at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from millrace.operators.changes import upsert
from millrace.sources.versions import VersionedTable


def write_keyed(df: DataFrame, path: str, key: str, parts: int) -> None:
    """Write a table with unique keys in `parts` parts."""
    VersionedTable.create(df, path, [key], parts)


def read_keyed(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    return VersionedTable(spark, path).read(version)


def upsert_keyed(
    path: str, incoming: DataFrame, key: str, parts: int | None = None,
    deleted: Column | None = None, keep: int = 1, token: tuple[str, int] | None = None,
) -> None:
    """Update and insert rows by key, and delete where `deleted` holds.

    The table knows its key and number of parts; others given here are refused.
    Only parts with incoming keys are read and written. The last `keep` versions
    stay readable; the files of older ones are removed afterwards. A `token`
    (stream, batch) makes a repeated batch change nothing.
    """
    table = VersionedTable(incoming.sparkSession, path)
    base = table.manifest()
    if (base.columns, base.parts) != ([key], parts or base.parts):
        raise ValueError(f"the table is split by {base.columns[0]} into {base.parts} parts")
    if token and base.tokens.get(token[0], -1) >= token[1]:
        return
    touched = table.labels(incoming, base)
    table.replace(upsert(table.read(base, touched), incoming, key, deleted), touched, base, token)
    table.forget(keep)
