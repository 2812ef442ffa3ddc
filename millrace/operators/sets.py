"""Set operations on whole rows, and comparison of two tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return (df.select(*columns) if columns else df).distinct()


def union_by_name(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b)


def union_all(a: DataFrame, b: DataFrame) -> DataFrame:
    """By position; the first frame's column names win."""
    return a.union(b)


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.union(b).distinct()


def intersect(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)


def except_rows(a: DataFrame, b: DataFrame, keep_duplicates: bool = False) -> DataFrame:
    """Rows of `a` not in `b`. With `keep_duplicates` a row of `a` stays as often as
    it occurs there, instead of once. Nulls compare as equal either way."""
    if not keep_duplicates:
        return a.subtract(b)
    same = reduce(lambda x, y: x & y, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in a.columns])
    return a.alias("a").join(b.distinct().alias("b"), same, "left_anti")


def reconcile(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys on which two tables with unique keys differ, with how: only_left,
    only_right or changed."""
    values = [c for c in a.columns if c != key]
    left = a.select(key, F.struct(*values).alias("l"))
    right = b.select(key, F.struct(*values).alias("r"))
    status = (
        F.when(F.col("r").isNull(), "only_left")
        .when(F.col("l").isNull(), "only_right")
        .when(F.col("l") != F.col("r"), "changed")
    )
    return left.join(right, key, "full_outer").select(key, status.alias("status")).where("status IS NOT NULL")
