"""Joins. Strategy is Spark's choice from measured sizes unless the name says otherwise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def inner_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    return left.join(right, on)


def left_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    return left.join(right, on, "left")


def semi_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Left rows with a match, each once."""
    return left.join(right, on, "left_semi")


def anti_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Left rows without a match."""
    return left.join(right, on, "left_anti")


def hash_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Shuffled hash join building on `right`: no sort; `right` must be the small side."""
    return left.join(right.hint("shuffle_hash"), on)


def merge_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Sort-merge join: spills, so neither side has to fit in memory."""
    return left.join(right.hint("merge"), on)


def _versioned(version: Sequence[str], columns: Sequence[str]) -> Column:
    """A whole row that compares by its version first."""
    return F.struct(F.struct(*version).alias("_version"), *columns)


def newest(a: DataFrame, b: DataFrame, key: str, version: Sequence[str]) -> DataFrame:
    """Row-level merge of two batches with unique keys: per key the whole row with
    the greater version, never a mix of the two."""
    columns = a.columns
    packed = [df.select(_versioned(version, columns).alias(n), key) for df, n in ((a, "x"), (b, "y"))]
    both = packed[0].join(packed[1], key, "full_outer")
    row = F.when(F.col("y").isNull() | (F.col("x") >= F.col("y")), F.col("x")).otherwise(F.col("y"))
    picked = both.select(row.alias("row"))
    return picked.select(*[F.col("row")[c].alias(c) for c in columns])


def sum_having(
    facts: DataFrame, dim: DataFrame, key: str, value: Column, over: float, name: str = "total"
) -> DataFrame:
    """Dimension rows whose facts sum to more than `over`.

    The facts shrink to one row per key before they meet the dimension.
    """
    totals = facts.groupBy(key).agg(F.sum(value).alias(name)).where(F.col(name) > over)
    return dim.join(totals, key)


def sum_or_zero(dim: DataFrame, facts: DataFrame, key: str, value: Column, name: str = "total") -> DataFrame:
    """Every dimension row with the sum of its facts, 0 if it has none."""
    totals = facts.groupBy(key).agg(F.sum(value).alias(name))
    return dim.join(totals, key, "left").fillna(0, [name])


def join_nulls(left: DataFrame, right: DataFrame, left_key: str, right_key: str, mode: str, sentinel=None) -> DataFrame:
    """Join on a nullable key. `mode`: "drop" lets null match nothing, "safe" lets
    null match null, "sentinel" replaces null on the left side by a value."""
    l, r = F.col(left_key), F.col(right_key)
    if mode == "drop":
        return left.join(right, l == r)
    if mode == "safe":
        return left.join(right, l.eqNullSafe(r))
    if mode == "sentinel":
        return left.join(right, F.coalesce(l, F.lit(sentinel)) == r)
    raise ValueError(f"unknown mode {mode!r}")


def join_normalised(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Join text keys that differ in case and padding, or are stored as other types."""

    def clean(name: str) -> Column:
        return F.lower(F.trim(F.col(name).cast("string")))

    return left.join(right, clean(left_key) == clean(right_key))


def latest_row(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The whole row with the greatest `order` per key, ties by the rest of the row.

    One aggregation: a map task sends one row per key, whatever the key's size.
    """
    top = df.groupBy(key).agg(F.max(_versioned(order, df.columns)).alias("row"))
    return top.select(*[F.col("row")[c].alias(c) for c in df.columns])


def interval_join(
    a: DataFrame, b: DataFrame, key: str, a_ts: str, b_ts: str, seconds: int
) -> DataFrame:
    """Pairs with the same key and `a_ts <= b_ts <= a_ts + seconds`.

    Both sides meet on (key, time slot), so a hot key spreads over its slots. The
    `b` side is sent to its own slot and the one before, where any partner must be.
    """
    def slot(ts: str) -> Column:
        return F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / F.lit(seconds * 1_000_000))

    left = a.withColumn("_slot", slot(a_ts))
    right = b.withColumn("_slot", F.explode(F.array(slot(b_ts), slot(b_ts) - 1)))
    in_time = (F.col(a_ts) <= F.col(b_ts)) & (
        F.col(b_ts) <= F.col(a_ts) + F.expr(f"INTERVAL {seconds} SECONDS")
    )
    return left.join(right, [key, "_slot"]).where(in_time).drop("_slot")


def year_over_year(daily: DataFrame, day: str, value: str) -> DataFrame:
    """A gap-free daily series next to the same calendar day one year earlier.

    29 February has no such day and gets null.
    """
    earlier = F.when(F.date_format(day, "MM-dd") != "02-29", F.add_months(day, -12))
    before = daily.select(F.col(day).alias("_day"), F.col(value).alias("last_year"))
    return daily.withColumn("_day", earlier).join(before, "_day", "left").drop("_day")


def fanout_report(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """What joining on `on` would do to row counts, without doing it.

    One row: rows on each side, keys repeated on each side, rows the inner join
    would give (as a decimal: on skewed keys it may exceed a long).
    """
    l = left.groupBy(on).agg(F.count("*").alias("l"))
    r = right.groupBy(on).agg(F.count("*").alias("r"))
    both = l.join(r, on, "full_outer")
    return both.agg(
        F.coalesce(F.sum("l"), F.lit(0)).alias("left_rows"),
        F.coalesce(F.sum("r"), F.lit(0)).alias("right_rows"),
        F.count_if(F.col("l") > 1).alias("left_repeated_keys"),
        F.count_if(F.col("r") > 1).alias("right_repeated_keys"),
        F.coalesce(F.sum(F.col("l").cast("decimal(19,0)") * F.col("r").cast("decimal(19,0)")), F.lit(0)).cast("decimal(38,0)").alias("joined_rows"),
    )
