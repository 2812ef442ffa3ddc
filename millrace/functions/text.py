"""Text functions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def text_case(df: DataFrame, column: str) -> DataFrame:
    """Add the trimmed, upper-case and lower-case forms."""
    clean = F.trim(column)
    return df.withColumns({"trimmed": clean, "upper": F.upper(clean), "lower": F.lower(clean)})


def text_prefix(df: DataFrame, column: str, n: int, name: str = "prefix") -> DataFrame:
    return df.withColumn(name, F.substring(column, 1, n))


def split_words(df: DataFrame, column: str, pattern: str = r"\s+", name: str = "words") -> DataFrame:
    """Split at a pattern after trimming, so padding makes no empty parts."""
    return df.withColumn(name, F.split(F.trim(column), pattern))


def extract(df: DataFrame, column: str, pattern: str, group: int = 1, name: str = "match") -> DataFrame:
    """A group of the first match, '' where there is none."""
    return df.withColumn(name, F.regexp_extract(column, pattern, group))


def mask(df: DataFrame, column: str, pattern: str, text: str) -> DataFrame:
    """Replace every match."""
    return df.withColumn(column, F.regexp_replace(column, pattern, text))


def parse_log(df: DataFrame, column: str, fields: Mapping[str, str]) -> DataFrame:
    """One column per field, from a pattern with one group each."""
    return df.withColumns({name: F.regexp_extract(column, pattern, 1) for name, pattern in fields.items()})


def concat_cols(df: DataFrame, name: str, *parts: Column) -> DataFrame:
    return df.withColumn(name, F.concat(*parts))
