"""Finding hot keys, and joins that spread them over many tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import stored

# A key is hot only if it holds at least this share of all rows, so a table has
# at most 1 / HOT_SHARE hot keys and a frame of hot keys is safe to broadcast.
HOT_SHARE = 1e-5
HOT_ROWS = 1_000_000
# Most rows and bytes a side may have to be hinted as a broadcast.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 << 20


# Rows of one key that a task should get at most, and the least number of salts.
ROWS_PER_TASK = 1_000_000
LEAST_SALTS = 16
SALTED_KINDS = ("inner", "left", "left_semi", "left_anti")


def pieces(rows: int, least: int = LEAST_SALTS) -> int:
    """Into how many parts `rows` rows of one key, or of a table without keys, are cut."""
    return max(least, -(-rows // ROWS_PER_TASK))


def row_salt(ids: Sequence[str], n: int | Column) -> Column:
    """A salt that depends on the row alone, so a retried task repeats it."""
    return F.pmod(F.xxhash64(*ids), F.lit(n) if isinstance(n, int) else n)


def hot_groups(df: DataFrame, keys: Sequence[str], hot_rows: int | None = HOT_ROWS) -> DataFrame | None:
    """Key groups with at least `max(hot_rows, HOT_SHARE * all rows)` rows, or None.

    With `hot_rows=None` the caller vouches that no group is hot and nothing runs.

    Runs now, reading only the key columns, so that plans over tables without hot
    groups need no skew handling at all. The keys come packed in the struct
    `_group`, which compares null keys as equal, with their `_rows`: at most
    1 / HOT_SHARE rows, kept in the shared folder.
    """
    if hot_rows is None:
        return None
    counts = df.groupBy(F.struct(*keys).alias("_group")).agg(F.count("*").alias("_rows"))
    total = df.agg(F.count("*").alias("n")).scalar()
    enough = F.greatest(F.lit(float(hot_rows)), total * F.lit(HOT_SHARE))
    hot = stored(counts.where(F.col("_rows") >= enough))
    return None if hot.isEmpty() else hot


def hot_keys(df: DataFrame, key: str, share: float) -> DataFrame:
    """Report keys holding at least `share` of all rows; at most 1 / share rows come back."""
    counts = df.groupBy(key).agg(F.count("*").alias("rows"))
    total = df.agg(F.count("*").alias("n")).scalar()
    return counts.withColumn("share", F.col("rows") / total).where(F.col("share") >= share)


def small_enough(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether `df` is within both bounds. One pass, which stops when it has seen too many rows."""
    text = F.octet_length(F.to_json(F.struct(*df.columns)))
    seen = df.select(text.alias("b")).limit(rows + 1).agg(F.count("*").alias("n"), F.coalesce(F.sum("b"), F.lit(0)).alias("b")).first()
    return seen["n"] <= rows and seen["b"] <= size


def broadcast_join(big: DataFrame, small: DataFrame, on, how: str = "inner", rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast `small` if it is small enough; otherwise leave the strategy to Spark."""
    return big.join(F.broadcast(small) if small_enough(small, rows) else small, on, how)


def salted_join(
    large: DataFrame,
    small: DataFrame,
    key: str,
    row_id: Sequence[str],
    salts: int | None = None,
    share: float = 0.01,
    how: str = "inner",
) -> DataFrame:
    """Join with the large side's hot keys spread over `salts` tasks, by default
    as many as the hottest key's rows ask for.

    Only hot keys are salted on the large side and replicated on the small one;
    all others carry salt 0 on both sides. The hot-key frame has at most
    1 / share rows, so broadcasting it is bounded. `how`: inner, left, left_semi
    or left_anti (the large side is the left one); the other kinds would repeat
    the small side's unmatched rows per salt and are refused.
    """
    if how not in SALTED_KINDS:
        raise ValueError(f"how must be one of {', '.join(SALTED_KINDS)}")
    found = stored(hot_keys(large, key, share).select(key, "rows", F.lit(True).alias("_hot")))
    most = found.agg(F.max("rows").alias("n")).first()["n"]
    if most is None:
        return large.join(small, key, how)
    salts = salts or pieces(most)
    hot = F.broadcast(found.drop("rows"))
    left = large.join(hot, key, "left").withColumn(
        "_salt", F.when(F.col("_hot"), row_salt(row_id, salts)).otherwise(F.lit(0).cast("bigint"))
    )
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint")))
    right = small.join(hot, key, "left").withColumn(
        "_salt", F.explode(F.coalesce(copies, F.array(F.lit(0).cast("bigint"))))
    )
    return left.drop("_hot").join(right.drop("_hot"), [key, "_salt"], how).drop("_salt")


def split_hot_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    row_id: Sequence[str],
    share: float = 0.01,
    rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Inner join with the hot keys taken out and joined on their own.

    The right side's rows for the hot keys are broadcast when there are few
    enough of them, and joined by salt when not.
    """
    found = stored(hot_keys(left, key, share).select(key))
    if found.isEmpty():
        return left.join(right, key)
    hot = F.broadcast(found)
    hot_left, hot_right = left.join(hot, key, "left_semi"), right.join(hot, key, "left_semi")
    if small_enough(hot_right, rows):
        hot_part = hot_left.join(F.broadcast(hot_right), key)
    else:
        hot_part = salted_join(hot_left, hot_right, key, row_id, share=share)
    # A null key is not hot and matches nothing, so the anti join keeps it harmlessly.
    rest = left.join(hot, key, "left_anti").join(right, key)
    return hot_part.unionByName(rest)


def with_group_total(df: DataFrame, keys: Sequence[str], **totals: Column) -> DataFrame:
    """Each row with aggregates of its group: aggregated map-side first, then
    joined back, so a hot group never sits in one window task."""
    groups = df.groupBy(F.struct(*keys).alias("_group")).agg(*[c.alias(n) for n, c in totals.items()])
    return df.withColumn("_group", F.struct(*keys)).join(groups, "_group").drop("_group")
