"""Null handling and casts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fill_expr(df: DataFrame, column: str, value: Column) -> DataFrame:
    return df.withColumn(column, F.coalesce(F.col(column), value))


def fill_nulls(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.fillna(dict(values))


def drop_nulls(df: DataFrame, how: str = "any", columns: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(how, subset=list(columns) if columns else None)


def cast_cols(df: DataFrame, types: Mapping[str, str], strict: bool = True) -> DataFrame:
    """Cast columns; with `strict` off, a value that does not fit becomes null."""
    def convert(name: str, kind: str) -> Column:
        return F.col(name).cast(kind) if strict else F.col(name).try_cast(kind)

    return df.withColumns({name: convert(name, kind) for name, kind in types.items()})


def greatest_of(df: DataFrame, columns: Sequence[str], name: str = "greatest") -> DataFrame:
    """Row-wise maximum, nulls ignored."""
    return df.withColumn(name, F.greatest(*columns))


def least_of(df: DataFrame, columns: Sequence[str], name: str = "least") -> DataFrame:
    return df.withColumn(name, F.least(*columns))


def arith(df: DataFrame, a: str, b: str) -> DataFrame:
    """Sum, product, quotient (null when dividing by zero) and remainder of two columns."""
    x, y = F.col(a), F.col(b)
    return df.withColumns({
        "added": x + y, "multiplied": x * y, "divided": F.try_divide(x, y), "remainder": F.try_mod(x, y)
    })
