"""How rows are spread over partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import stored


def repartition_by(df: DataFrame, n: int | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """Full shuffle to `n` partitions, by `keys` if given; without `n` the number
    is left to adaptive execution."""
    if n is None:
        return df.repartition(*keys)
    return df.repartition(n, *keys)


def shrink(df: DataFrame, n: int) -> DataFrame:
    """Merge partitions without a shuffle."""
    return df.coalesce(n)


def cut_lineage(df: DataFrame) -> DataFrame:
    """The same rows with a plan that starts at a stored copy."""
    return stored(df)


def partition_profile(df: DataFrame) -> DataFrame:
    """Rows in each partition that has any."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count("*").alias("rows"))


def range_profile(df: DataFrame, key: str, n: int) -> DataFrame:
    """Rows and key range per partition after range partitioning."""
    ranged = df.select(key).repartitionByRange(n, key)
    return ranged.groupBy(F.spark_partition_id().alias("partition")).agg(
        F.count("*").alias("rows"), F.min(key).alias("lowest"), F.max(key).alias("highest")
    )
