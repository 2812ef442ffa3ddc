"""User functions. Built-in expressions are the default; these are for code that
has no expression form."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.arrow_udf(T.DoubleType())
def revenue_udf(units: pa.Array, price: pa.Array) -> pa.Array:
    """Units times price over Arrow batches."""
    return pc.multiply(units.cast(pa.float64()), price)


def register_revenue(spark: SparkSession, name: str = "revenue") -> None:
    """Make `revenue_udf` callable from SQL."""
    spark.udf.register(name, revenue_udf)


def revenue_expr(units: str, price: str) -> Column:
    """The same as an expression, which stays in generated code."""
    return F.col(units).cast("double") * F.col(price)


def mean_or(df: DataFrame, keys: Sequence[str], value: Column, default: float, name: str = "mean") -> DataFrame:
    """Mean per group, `default` for a group without values.

    Sum and count merge before the shuffle; a Python aggregate would pull each
    group whole into one worker.
    """
    average = F.try_divide(F.sum(value).cast("double"), F.count(value))
    return df.groupBy(*keys).agg(F.coalesce(average, F.lit(float(default))).alias(name))


@F.pandas_udf(T.DoubleType())
def mean_udaf(values: pd.Series) -> float:
    """Grouped-aggregate form of the mean, for groups known to fit one worker."""
    return float(values.mean()) if values.notna().any() else -1.0
