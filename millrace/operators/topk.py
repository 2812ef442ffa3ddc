"""Sorting, limits and best rows per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.skew import row_salt
from millrace.operators.windows import sort_columns, sort_names

TIES = {"row_number": F.row_number, "rank": F.rank, "dense_rank": F.dense_rank}


def sort_by(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Total order over the whole result (`-name` for descending)."""
    return df.orderBy(*sort_columns(order))


def top_n(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """First `n` rows: each task keeps n, so no full sort happens."""
    return sort_by(df, order).limit(n)


def top_n_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, ties: str = "row_number", name: str = "position"
) -> DataFrame:
    """Rows placed in the first `n` of their key under the tie policy `ties`.

    The filter sits right on the rank, so Spark drops rows that cannot qualify
    before it shuffles: a hot key sends about n rows per map task. It does so up
    to n = `spark.sql.optimizer.windowGroupLimitThreshold`, which the library's
    sessions raise; `top_n_two_pass` spreads a hot key's rows at any n.
    """
    w = Window.partitionBy(*keys).orderBy(*sort_columns(order))
    ranked = df.withColumn(name, TIES[ties]().over(w)).where(F.col(name) <= n)
    return ranked.withColumn(name, F.col(name).cast("bigint"))


def top_ties_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    n: int,
    ties: str,
    row_id: Sequence[str],
    name: str = "position",
    salts: int = 32,
) -> DataFrame:
    """`top_n_per_key` by rank or dense_rank when very many rows may tie.

    The best places are found on the order columns alone, per (key, salt) first,
    where ties collapse to a count; the rows are then matched with them. A third
    of the table tied in first place never meets in one task.
    """
    names = sort_names(order)
    salted = df.select(*keys, *names, row_salt(row_id, salts).alias("_salt"))
    near = top_n_per_key(salted, [*keys, "_salt"], order, n, "dense_rank", "_place")
    # Every row with one of a key's n best values is still there, so counts are exact.
    best = near.groupBy(*keys, *names).agg(F.count("*").alias("_same"))
    best = top_n_per_key(best, keys, order, n, name="_place")
    if ties == "rank":
        above = Window.partitionBy(*keys).orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
        best = best.withColumn("_place", F.coalesce(F.sum("_same").over(above), F.lit(0)) + 1)
    places = best.where(F.col("_place") <= n).select(
        F.struct(*keys, *names).alias("_peer"), F.col("_place").alias(name)
    )
    return df.withColumn("_peer", F.struct(*keys, *names)).join(places, "_peer").drop("_peer")


def best_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first in `order`; make `order` unique within a key."""
    return top_n_per_key(df, keys, order, 1, name="_place").drop("_place")


def top_n_two_pass(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, row_id: Sequence[str], salts: int = 32
) -> DataFrame:
    """`top_n_per_key` in two rounds: per (key, salt) first, then per key, for
    tables with so many map tasks that even n rows from each is too many for one."""
    salted = df.withColumn("_salt", row_salt(row_id, salts))
    first = top_n_per_key(salted, [*keys, "_salt"], order, n, name="_place").drop("_salt", "_place")
    return top_n_per_key(first, keys, order, n)


def range_sort(df: DataFrame, key: str, n: int) -> DataFrame:
    """`n` partitions holding successive ranges of `key`, each sorted."""
    return df.repartitionByRange(n, key).sortWithinPartitions(key)


def top_buyers(orders: DataFrame, customers: DataFrame, key: str, country: str, value: Column, n: int) -> DataFrame:
    """The `n` customers who spent most in each country, next to the country's total.

    Orders shrink to one row per customer first, and both results come from that.
    """
    spent = orders.groupBy(key).agg(F.sum(value).alias("spent")).join(customers, key)
    totals = spent.groupBy(country).agg(F.sum("spent").alias("country_total"))
    return top_n_per_key(spent, [country], ["-spent", key], n).join(totals, country)
