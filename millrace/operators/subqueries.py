"""Queries inside queries: scalar values, membership tests, per-row lookups."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.topk import top_n_per_key


def scalar(df: DataFrame, agg: Column) -> Column:
    """One aggregate of `df` as a value usable in any other query's expressions.

    It runs as part of that query, so nothing is fetched to the driver.
    """
    return df.agg(agg.alias("value")).scalar()


def with_global(df: DataFrame, source: DataFrame, aggs: Mapping[str, Column]) -> DataFrame:
    """Each row of `df` next to aggregates over all of `source`."""
    return df.withColumns({name: scalar(source, agg) for name, agg in aggs.items()})


def above(df: DataFrame, value: Column, agg: Column) -> DataFrame:
    """Rows whose `value` is greater than an aggregate over the whole frame."""
    return df.where(value > scalar(df, agg))


def in_subquery(df: DataFrame, key: str, other: DataFrame, other_key: str) -> DataFrame:
    return df.join(other.select(F.col(other_key).alias(key)), key, "left_semi")


def not_in(df: DataFrame, key: str, other: DataFrame, other_key: str) -> DataFrame:
    """SQL's NOT IN with three-valued logic, as an ordinary anti join.

    A row stays if the list is empty, or if its key is not null, the list holds
    no null and the key is not in it. Spark's own NOT IN broadcasts the list
    whatever its size; this form shuffles when the list is large.
    """
    members = other.select(F.col(other_key).alias(key))
    nulls = F.count_if(F.col(key).isNull())
    facts = scalar(members, F.struct(F.count("*").alias("n"), nulls.alias("nulls")))
    usable = (facts["nulls"] == 0) & F.col(key).isNotNull()
    known = df.where((facts["n"] == 0) | usable)
    return known.join(members.where(F.col(key).isNotNull()), key, "left_anti")


def exists(df: DataFrame, other: DataFrame, condition: Column | Sequence[str] | str) -> DataFrame:
    return df.join(other, condition, "left_semi")


def not_exists(df: DataFrame, other: DataFrame, condition: Column | Sequence[str] | str) -> DataFrame:
    """Unlike `not_in`, a null on either side just fails to match."""
    return df.join(other, condition, "left_anti")


def correlated(
    outer: DataFrame, inner: DataFrame, key: str, aggs: Mapping[str, Column], zero: Sequence[str] = ()
) -> DataFrame:
    """Per outer row, aggregates over the inner rows with its key.

    Names in `zero` (counts) are 0 and others null where there are no rows. Works
    over any outer frame, unions included.
    """
    groups = inner.groupBy(key).agg(*[c.alias(n) for n, c in aggs.items()])
    joined = outer.join(groups, key, "left")
    return joined.fillna(0, list(zero)) if zero else joined


def where_count_gt(outer: DataFrame, inner: DataFrame, key: str, n: int) -> DataFrame:
    """Outer rows with more than `n` inner rows of the same key."""
    busy = inner.groupBy(key).agg(F.count("*").alias("rows")).where(F.col("rows") > n)
    return outer.join(busy, key)


def lateral_top(
    outer: DataFrame, inner: DataFrame, key: str, order: Sequence[str], n: int = 1
) -> DataFrame:
    """Per outer row its first `n` inner rows; outer rows without any stay."""
    return outer.join(top_n_per_key(inner, [key], order, n, name="place"), key, "left")


@contextmanager
def reused(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Keep a result that several later queries read, and release it afterwards."""
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()
