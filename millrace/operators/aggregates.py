"""Aggregations. Each combines on the map side before rows are shuffled."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from millrace.operators.skew import HOT_SHARE
from millrace.operators.windows import Split, SplitWindow
from millrace.session import stored

# Rows of a hot key that a median is placed among at last, and the quantiles that narrow them at each step.
BRACKET_ROWS = 100_000
STEPS = 200


def money(column: str | Column, scale: int = 2) -> Column:
    """Exact decimal form of a money column, so sums do not depend on row order."""
    return (F.col(column) if isinstance(column, str) else column).cast(f"decimal(18,{scale})")


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows"))


def count_where(df: DataFrame, predicate: Column) -> DataFrame:
    return row_count(df.where(predicate))


def count_by(df: DataFrame, keys: Sequence[str], at_least: int = 0) -> DataFrame:
    """Rows per group, keeping groups with `at_least` of them."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("rows"))
    return counts.where(F.col("rows") >= at_least) if at_least else counts


def sum_by(df: DataFrame, keys: Sequence[str], value: Column, name: str = "total") -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(value).alias(name))


def mean(value: Column) -> Column:
    """Average as a double, from a sum that is exact when `value` is a decimal."""
    return F.try_divide(F.sum(value).cast("double"), F.count(value))


def avg_by(df: DataFrame, keys: Sequence[str], value: Column, name: str = "average") -> DataFrame:
    return df.groupBy(*keys).agg(mean(value).alias(name))


def multi_agg(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])


def null_agg(df: DataFrame, column: str) -> DataFrame:
    """How COUNT, SUM and AVG treat nulls in `column`, in one row."""
    c = F.col(column)
    return df.agg(
        F.count("*").alias("rows"),
        F.count(c).alias("present"),
        F.count_if(c.isNull()).alias("missing"),
        F.sum(c).alias("total"),
        mean(c).alias("average"),
        F.try_divide(F.sum(c).cast("double"), F.count("*")).alias("average_as_zero"),
    )


def rollup_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Subtotals from left to right; `level` (grouping id) tells them from null keys."""
    return df.rollup(*keys).agg(F.count("*").alias("rows"), F.grouping_id().alias("level"))


def cube_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Subtotals for every combination of keys."""
    return df.cube(*keys).agg(F.count("*").alias("rows"), F.grouping_id().alias("level"))


def grouping_sets(
    df: DataFrame, sets: Sequence[Sequence[str]], keys: Sequence[str], aggs: Mapping[str, Column]
) -> DataFrame:
    """Totals for an explicit list of key sets in one pass."""
    return df.groupingSets([[F.col(c) for c in s] for s in sets], *keys).agg(
        *[c.alias(n) for n, c in aggs.items()], F.grouping_id().alias("level")
    )


def pivot_sum(df: DataFrame, key: str, pivot: str, values: Sequence[str], value: Column) -> DataFrame:
    """One column per listed value; a cell without rows is null."""
    return df.groupBy(key).pivot(pivot, list(values)).agg(F.sum(value))


def case_pivot(df: DataFrame, key: str, pivot: str, values: Sequence[str], value: Column) -> DataFrame:
    """As `pivot_sum`, but a cell without rows is 0."""
    return df.groupBy(key).agg(
        *[F.sum(F.when(F.col(pivot) == v, value).otherwise(F.lit(0))).alias(v) for v in values]
    )


def unpivot(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str, value: str) -> DataFrame:
    return df.unpivot(list(ids), list(values), name, value)


def ordered_list(
    df: DataFrame, key: str, value: str, order: Sequence[str], split: Split, longest: int = 10_000
) -> DataFrame:
    """Values of each key in order, as lists of at most `longest` elements.

    A key with more rows gets several lists, numbered by `part`; nothing is cut
    off, and no single row has to hold a hot key's whole history.
    """
    placed = SplitWindow(df, [key], order, split).number("_rn").frame()
    part = F.floor((F.col("_rn") - 1) / longest)
    lists = placed.groupBy(key, part.alias("part")).agg(
        F.array_sort(F.collect_list(F.struct("_rn", F.col(value).alias("v")))).alias("_rows")
    )
    return lists.select(key, "part", F.col("_rows.v").alias("items"))


def distinct_list(df: DataFrame, key: str, value: str, split: Split, longest: int = 10_000) -> DataFrame:
    """Sorted distinct values of each key, in lists as `ordered_list` makes them."""
    return ordered_list(df.select(key, value).distinct(), key, value, [value], split, longest)


def distinct_count(df: DataFrame, column: str, keys: Sequence[str] = ()) -> DataFrame:
    """Exact; duplicates go on the map side, so a hot key sends only its distinct values."""
    return df.groupBy(*keys).agg(F.count_distinct(column).alias("distinct_values"))


def approx_distinct(df: DataFrame, column: str, keys: Sequence[str] = (), rsd: float = 0.05) -> DataFrame:
    """Fixed-size sketch per group; relative standard deviation `rsd`."""
    return df.groupBy(*keys).agg(F.approx_count_distinct(column, rsd).alias("distinct_values"))


def _brackets(rows: DataFrame, bracket_rows: int) -> DataFrame:
    """Per key of `rows` (_key, _v): bounds around its middle values, with the rows below and inside.

    Approximate quantiles of what is inside the bounds narrow them, until each
    key has at most `bracket_rows` rows inside or its bounds stay. Bounds that
    turn out to miss a middle rank are not taken.
    """
    low, high = F.floor((F.col("_n") + 1) / 2), F.floor((F.col("_n") + 2) / 2)
    bounds = stored(rows.groupBy("_key").agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count("*").alias("_n")).withColumns({"_below": F.lit(0).cast("bigint"), "_in": F.col("_n")}))
    while True:
        inside = F.col("_v").between(F.col("_lo"), F.col("_hi"))
        met = rows.join(F.broadcast(bounds), "_key").where(inside)
        cuts = met.groupBy("_key").agg(F.percentile_approx("_v", [k / STEPS for k in range(STEPS + 1)], 10 * STEPS).alias("_q"))
        at = lambda rank, step: F.element_at("_q", F.greatest(F.lit(1), F.least(F.lit(STEPS + 1), F.floor((rank - F.col("_below")) * STEPS / F.col("_in")) + 1 + step)).cast("int"))
        tried = bounds.join(cuts, "_key").select("_key", "_n", at(low, -2).alias("_lo"), at(high, 2).alias("_hi"), F.struct("_lo", "_hi", "_below", "_in").alias("_old"))
        counted = rows.join(F.broadcast(tried.select("_key", "_lo", "_hi")), "_key").groupBy("_key").agg(
            F.count_if(F.col("_v") < F.col("_lo")).alias("_below"), F.count_if(inside).alias("_in")
        )
        sound = (F.col("_below") < low) & (high <= F.col("_below") + F.col("_in")) & (F.col("_in") < F.col("_old._in"))
        narrowed = tried.join(counted, "_key").select("_key", "_n", *[F.when(sound, F.col(c)).otherwise(F.col("_old")[c]).alias(c) for c in ("_lo", "_hi", "_below", "_in")], sound.alias("_new"))
        narrowed = stored(narrowed)
        bounds = narrowed.drop("_new")
        if narrowed.where(F.col("_new") & (F.col("_in") > bracket_rows)).isEmpty():
            return bounds


def median_by(df: DataFrame, key: str, value: str, split: Split, bracket_rows: int = BRACKET_ROWS) -> DataFrame:
    """Exact median per key.

    Rows are counted per key once. A hot key's middle ranks are bracketed by
    approximate quantiles, and what lies outside the brackets is only counted;
    of the rest, equal values collapse to a count and running counts place the
    middle ranks. So no task gets more than a key's bracket, or a key that is not
    hot. Null values are left out; a null key is a key.
    """
    present = df.where(F.col(value).isNotNull()).select(F.struct(key).alias("_key"), F.col(value).alias("_v"))
    sizes = stored(present.groupBy("_key").agg(F.count("*").alias("_n")))
    plain, offsets = present, None
    if split.hot_rows is not None:
        total = sizes.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
        hot = sizes.where(F.col("_n") >= max(split.hot_rows, HOT_SHARE * total))
        if not hot.isEmpty():
            few = F.broadcast(hot.select("_key"))  # at most 1 / HOT_SHARE keys
            rows = present.join(few, "_key", "left_semi")
            offsets = _brackets(rows, bracket_rows)
            inside = F.col("_v").between(F.col("_lo"), F.col("_hi"))
            middle = rows.join(F.broadcast(offsets.select("_key", "_lo", "_hi")), "_key").where(inside)
            plain = present.join(few, "_key", "left_anti").unionByName(middle.select("_key", "_v"))
    weights = plain.groupBy("_key", "_v").agg(F.count("*").alias("_w")).join(sizes, "_key")
    if offsets is None:
        weights = weights.withColumn("_below", F.lit(0).cast("bigint"))
    else:
        weights = weights.join(F.broadcast(offsets.select("_key", "_below")), "_key", "left").withColumn("_below", F.coalesce("_below", F.lit(0)))
    upto = F.col("_below") + F.sum("_w").over(Window.partitionBy("_key").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    placed = weights.withColumn("_upto", upto)
    # The middle ranks are (n + 1) div 2 and (n + 2) div 2, equal when n is odd.
    low, high = F.floor((F.col("_n") + 1) / 2), F.floor((F.col("_n") + 2) / 2)
    before = F.col("_upto") - F.col("_w")
    at = lambda rank: F.max(F.when((before < rank) & (rank <= F.col("_upto")), F.col("_v")))
    found = placed.where((before < high) & (F.col("_upto") >= low)).groupBy("_key").agg(((at(low) + at(high)) / 2).alias("median"))
    return found.select(F.col("_key")[key].alias(key), "median")


def approx_percentile_by(df: DataFrame, keys: Sequence[str], value: str, p: float, accuracy: int = 10_000) -> DataFrame:
    """Approximate percentile in bounded memory; rank error at most rows / accuracy."""
    return df.groupBy(*keys).agg(F.percentile_approx(value, p, accuracy).alias("percentile"))


def agg_of_agg(df: DataFrame, inner: Sequence[str], value: Column, outer: Mapping[str, Column]) -> DataFrame:
    """Aggregate `total` and `rows` of the groups `inner`."""
    groups = df.groupBy(*inner).agg(F.sum(value).alias("total"), F.count("*").alias("rows"))
    return groups.agg(*[c.alias(n) for n, c in outer.items()])


def map_totals(df: DataFrame, key: str, category: str, value: Column) -> DataFrame:
    """Per key a map from category to total, entries sorted by category.

    For categories with a fixed set of values; rows are summed before any map is built.
    """
    totals = df.groupBy(key, category).agg(F.sum(value).alias("_t"))
    entries = F.sort_array(F.collect_list(F.struct(category, "_t")))
    return totals.groupBy(key).agg(F.map_from_entries(entries).alias("totals"))


def merge_aggregate(previous: DataFrame, delta: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Fold a batch's sums and counts into a running table without its history."""
    return previous.unionByName(delta).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])


def counted(df: DataFrame, predicates: Mapping[str, Column]) -> DataFrame:
    """One row with the number of rows meeting each predicate."""
    return df.agg(*[F.count_if(p).alias(n) for n, p in predicates.items()])


def observed(df: DataFrame, predicates: Mapping[str, Column], name: str = "counts") -> tuple[DataFrame, Observation]:
    """The same rows, with the counts available from the observation once they were read.

    Unlike a counter updated by tasks, a retried task is not counted twice.
    """
    seen = Observation(name)
    return df.observe(seen, *[F.count_if(p).alias(n) for n, p in predicates.items()]), seen
