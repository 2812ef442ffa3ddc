"""Projections, filters and row-by-row reshaping. All stay inside one stage."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def derive(df: DataFrame, columns: Mapping[str, Column], rename: Mapping[str, str] | None = None) -> DataFrame:
    """Add or replace columns, after renaming."""
    return df.withColumnsRenamed(dict(rename or {})).withColumns(dict(columns))


def where_eq(df: DataFrame, column: str, value) -> DataFrame:
    return df.where(F.col(column) == value)


def where_any(df: DataFrame, predicates: Sequence[Column]) -> DataFrame:
    return df.where(reduce(lambda a, b: a | b, predicates))


def where_all(df: DataFrame, predicates: Sequence[Column]) -> DataFrame:
    return df.where(reduce(lambda a, b: a & b, predicates))


def where_between(df: DataFrame, column: str, low, high) -> DataFrame:
    """Both ends included."""
    return df.where(F.col(column).between(low, high))


def where_prefix(df: DataFrame, column: str, prefix: str) -> DataFrame:
    """Literal prefix: `_` and `%` have no special meaning, and the scan can use it."""
    return df.where(F.col(column).startswith(prefix))


def where_in(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    return df.where(F.col(column).isin(list(values)))


def where_null(df: DataFrame, column: str, negate: bool = False) -> DataFrame:
    test = F.col(column).isNull()
    return df.where(~test if negate else test)


def where_false(df: DataFrame) -> DataFrame:
    """No rows, same columns; the plan becomes an empty relation that reads nothing."""
    return df.where(F.lit(False))


def case_when(df: DataFrame, name: str, branches: Sequence[tuple[Column, object]], otherwise) -> DataFrame:
    """First branch whose condition holds gives the value."""
    (condition, value), *rest = branches
    chosen = reduce(lambda c, b: c.when(b[0], b[1]), rest, F.when(condition, value))
    return df.withColumn(name, chosen.otherwise(otherwise))


def map_filter(df: DataFrame, columns: Mapping[str, Column], keep: Column) -> DataFrame:
    """Compute columns from each row, then keep the rows that pass."""
    return df.select(*[c.alias(n) for n, c in columns.items()]).where(keep)


def expand(df: DataFrame, array: Column, name: str) -> DataFrame:
    """One row per element of `array`; rows with an empty or null array give none."""
    return df.withColumn(name, F.explode(array))


def pair_with_values(df: DataFrame, values: Sequence, name: str) -> DataFrame:
    """Each row once per literal value: a dense grid whose width is known when it
    is written, in place of a product of two tables."""
    return expand(df, F.array(*[F.lit(v) for v in values]), name)


def map_batches(
    df: DataFrame,
    setup: Callable[[], object],
    transform: Callable[[object, pa.RecordBatch], pa.RecordBatch],
    schema: str,
) -> DataFrame:
    """Arrow batches through Python, with `setup` run once per partition."""

    def run(batches):
        resource = setup()
        for batch in batches:
            yield transform(resource, batch)

    return df.mapInArrow(run, schema)
