"""Checks that keep bad rows in sight instead of dropping them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tagged(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add `broken`: the names of the rules a row fails. A null outcome is a failure."""
    failed = [F.when(F.coalesce(ok, F.lit(False)), None).otherwise(F.lit(name)) for name, ok in rules.items()]
    return df.withColumn("broken", F.array_compact(F.array(*failed)))


def validate(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Good rows, and rejected rows with the rules they broke."""
    marked = tagged(df, rules)
    return marked.where(F.size("broken") == 0).drop("broken"), marked.where(F.size("broken") > 0)


def profile(df: DataFrame, key: str) -> DataFrame:
    """One row about a key column: rows, nulls, distinct values, repeated values,
    and the most rows any value has."""
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    present = F.col(key).isNotNull()
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(~present, F.col("n"))), F.lit(0)).alias("null_rows"),
        F.count(key).alias("distinct_values"),
        F.count_if(present & (F.col("n") > 1)).alias("repeated_values"),
        F.coalesce(F.max(F.when(present, F.col("n"))), F.lit(0)).alias("most_rows"),
    )
