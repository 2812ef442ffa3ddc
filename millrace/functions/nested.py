"""Structs, arrays, maps and JSON."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def struct_field(df: DataFrame, path: str, name: str) -> DataFrame:
    return df.withColumn(name, F.col(path))


def nest(df: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
    """Move columns into one struct."""
    return df.withColumn(name, F.struct(*columns)).drop(*columns)


def explode_array(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.withColumn(name, F.explode(column))


def map_get(df: DataFrame, column: str, key: str, name: str) -> DataFrame:
    """The value under a key, null where the map lacks it."""
    return df.withColumn(name, F.try_element_at(F.col(column), F.lit(key)))


def nested_filter(df: DataFrame, path: str, value, array: str, element) -> DataFrame:
    """Rows whose struct field equals a value and whose array holds an element."""
    return df.where((F.col(path) == value) & F.array_contains(array, element))


def map_avg(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Average of a map's values per group and map key."""
    entries = df.select(*keys, F.explode(column).alias("entry", "value"))
    return entries.groupBy(*keys, "entry").agg(
        F.try_divide(F.sum("value").cast("double"), F.count("value")).alias("average")
    )


def array_map(df: DataFrame, column: str, fn: Callable[[Column], Column], name: str) -> DataFrame:
    return df.withColumn(name, F.transform(column, fn))


def array_filter(df: DataFrame, column: str, keep: Callable[[Column], Column], name: str) -> DataFrame:
    return df.withColumn(name, F.filter(column, keep))


def array_any(df: DataFrame, column: str, test: Callable[[Column], Column], name: str) -> DataFrame:
    return df.withColumn(name, F.exists(column, test))


def array_sum(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.withColumn(name, F.aggregate(column, F.lit(0.0), lambda total, x: total + x))


def json_fields(df: DataFrame, column: str, schema: str, names: Mapping[str, str]) -> DataFrame:
    """Fields of a JSON text column; text that is not JSON gives nulls."""
    parsed = df.withColumn("_json", F.from_json(column, schema))
    return parsed.withColumns({n: F.col(f"_json.{path}") for n, path in names.items()}).drop("_json")
