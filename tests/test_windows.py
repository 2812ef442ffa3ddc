"""Split windows give what plain windows give, whatever is hot."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import plan_of, same
from millrace.operators import aggregates, windows
from millrace.operators.windows import FIRST, Split, SplitWindow


@pytest.fixture(scope="module")
def facts(spark, tables):
    """A third of the rows under one key, one null key, and ties in every order column."""
    o = tables["orders"]
    key = F.when(F.col("o_orderkey") % 3 == 0, 0).when(F.col("o_custkey") % 20 != 5, F.col("o_custkey") % 20)
    df = o.select(
        F.col("o_orderkey").alias("id"), key.alias("k"), F.trunc("o_orderdate", "week").alias("d"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("a"),
        F.when(F.col("o_orderkey") % 5 != 0, F.col("o_totalprice")).alias("holes"),
    ).withColumn("d", F.when(F.col("id") % 97 != 0, F.col("d")))
    return df.cache()


@pytest.mark.parametrize("hot", [2, 200, 10**9])
def test_rows_and_neighbours(facts, hot):
    split = Split(F.trunc("d", "quarter"), hot_rows=hot)
    got = (
        SplitWindow(facts, ["k"], ["d", "id"], split)
        .number("rn").running(F.col("a"), "upto").running(F.col("a"), "before", inclusive=False)
        .neighbour(F.col("a"), "back", -1).neighbour(F.col("holes"), "back3", -3, F.lit(-1.0))
        .neighbour(F.col("holes"), "ahead2", 2).last_known(F.col("holes"), "known").frame()
    )
    w = Window.partitionBy("k").orderBy("d", "id")
    want = facts.withColumns({
        "rn": F.row_number().over(w).cast("long"), "upto": F.sum("a").over(w.rowsBetween(FIRST, 0)),
        "before": F.sum("a").over(w.rowsBetween(FIRST, -1)), "back": F.lag("a").over(w),
        "back3": F.lag("holes", 3, -1.0).over(w), "ahead2": F.lead("holes", 2).over(w),
        "known": F.last("holes", True).over(w.rowsBetween(FIRST, -1)),
    })
    assert got.count() == facts.count()
    assert same(got, want)


@pytest.mark.parametrize("hot", [2, 10**9])
def test_ties_descending(facts, hot):
    split = Split(F.trunc("d", "year"), descending=True, hot_rows=hot)
    got = windows.with_peers(facts, ["k"], ["-d"], split, "rk", "dr", "s", F.col("a"))
    w = Window.partitionBy("k").orderBy(F.col("d").desc())
    want = facts.withColumns({
        "rk": F.rank().over(w).cast("long"), "dr": F.dense_rank().over(w).cast("long"), "s": F.sum("a").over(w),
    })
    assert same(got, want)


def test_where_keeps_the_order(facts):
    split = Split(F.trunc("d", "quarter"), hot_rows=50)
    odd = F.col("id") % 2 == 1
    got = SplitWindow(facts, ["k"], ["d", "id"], split).where(odd).neighbour(F.col("id"), "next", 1).frame()
    w = Window.partitionBy("k").orderBy("d", "id")
    assert same(got, facts.where(odd).withColumn("next", F.lead("id").over(w)))


def test_plain_plan_without_hot_groups(facts):
    df = SplitWindow(facts, ["k"], ["d", "id"], Split(F.col("d"))).number("rn").running(F.col("a"), "s").frame()
    plan = plan_of(df)
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Join" not in plan


def test_global_order_with_a_common_value(spark, facts):
    """A third of the rows share one value, which is cut by id, and some have none."""
    value = F.when(F.col("id") % 3 == 0, 5).when(F.col("id") % 11 != 0, F.floor(F.col("a") / 1000))
    df = facts.select("id", value.cast("decimal(18,2)").alias("a"))
    got = windows.global_running(df, "a", "id", slots=16, tie_step=64)
    by_id, by_value = Window.orderBy(F.col("a").desc(), "id"), Window.orderBy(F.col("a").desc())
    want = df.withColumns({
        "running": F.sum("a").over(by_id.rowsBetween(FIRST, 0)), "rank": F.rank().over(by_value).cast("long"),
        "dense_rank": F.dense_rank().over(by_value).cast("long"),
    })
    assert same(got, want)


def test_quantile_slots_are_even(facts):
    cut = windows.quantile_slot(facts.withColumn("x", F.col("id").cast("double")), "x", 10)
    sizes = [r["count"] for r in cut.groupBy("slot").count().collect()]
    assert len(sizes) == 10 and max(sizes) < facts.count() / 4


@pytest.mark.parametrize("hot", [3, 10**9])
def test_exact_median(facts, hot):
    split = Split(F.floor(F.col("holes") / 50_000), hot_rows=hot)
    got = aggregates.median_by(facts, "k", "holes", split)
    want = facts.where("holes IS NOT NULL").groupBy("k").agg(F.median("holes").alias("median"))
    assert same(got, want)


@pytest.mark.parametrize("bracket", [1, 30])
def test_exact_median_by_brackets(spark, bracket):
    """One key with most rows and a very common value, one of an even count without ties, a null key, and small ones."""
    n = F.col("id")
    key = F.when(n % 10 < 6, 1).when(n % 10 == 6, 2).when(n % 10 != 7, 3 + n % 50)
    value = F.when(key == 1, F.when(n % 3 == 0, 500).otherwise(n * 37 % 1000)).otherwise(n * 7919 % 100_003)
    df = spark.range(40_000).select(key.alias("k"), F.when(n % 23 != 0, value.cast("double")).alias("v"))
    got = aggregates.median_by(df, "k", "v", Split(hot_rows=3000), bracket)
    assert same(got, df.where("v IS NOT NULL").groupBy("k").agg(F.median("v").alias("median")))
    assert aggregates.median_by(df.where("k < 0"), "k", "v", Split(hot_rows=3000)).isEmpty()


def test_lists_are_split_not_cut(facts):
    split = Split(F.trunc("d", "quarter"), hot_rows=100)
    lists = aggregates.ordered_list(facts, "k", "id", ["d", "id"], split, longest=50)
    assert lists.agg(F.max(F.size("items"))).first()[0] == 50
    assert lists.agg(F.sum(F.size("items"))).first()[0] == facts.count()
    w = Window.partitionBy("k").orderBy("d", "id")
    first = facts.withColumn("rn", F.row_number().over(w)).where("rn = 51").select("k", F.col("id").alias("head"))
    second = lists.where("part = 1").select("k", F.col("items")[0].alias("head"))
    assert same(first, second)


def test_sessions(spark, tables):
    split = Split(F.date_trunc("day", "ts"), hot_rows=5)
    events = tables["events"].select("event_id", "user_id", "ts")
    got = windows.sessionize(events, "user_id", "ts", "6 HOURS", split, "event_id")
    sizes = got.groupBy("user_id", "session_no").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    whole = tables["events"].groupBy("user_id", F.session_window(F.col("ts").cast("timestamp"), "6 hours").alias("w")).count()
    assert sizes.count() == whole.count()


@pytest.mark.parametrize("value", [None, 4])
def test_global_order_of_few_values(spark, value):
    df = spark.range(5).select("id", F.lit(value).cast("decimal(18,2)").alias("a"))
    got = windows.global_running(df, "a", "id", slots=4)
    assert got.count() == 5 and {r["rank"] for r in got.collect()} == {1}
    assert windows.global_running(df.where("id < 0"), "a", "id").count() == 0


def test_no_count_when_the_caller_vouches(facts):
    split = Split(F.trunc("d", "quarter"), hot_rows=None)
    got = SplitWindow(facts, ["k"], ["d", "id"], split).number("n").frame()
    assert same(got, SplitWindow(facts, ["k"], ["d", "id"], Split(F.trunc("d", "quarter"), hot_rows=2)).number("n").frame())


def test_hot_groups_are_laid_out_once(facts):
    w = SplitWindow(facts, ["k"], ["d", "id"], Split(hot_rows=50)).number("rn").running(F.col("a"), "s")
    df = w.neighbour(F.col("a"), "back", -2).last_known(F.col("holes"), "known").frame()
    plan = plan_of(df)
    # The table is read once, for whole groups. Groups in slots read their stored copy,
    # whose rows are neither shuffled nor sorted again; only the carry table is.
    assert plan.count("InMemoryTableScan") == 1 and "SortMergeJoin" not in plan
    assert plan.count("hashpartitioning(k") == 1
    assert re.findall(r"hashpartitioning\(_group#\d+, ", plan) == [re.search(r"hashpartitioning\(_group#\d+, ", plan)[0]]
    assert plan.count("Sort [_group") == 1


def test_slots_follow_the_rows(spark):
    """All rows of one group and one day, in descending order."""
    df = spark.range(4000).select("id", F.lit(1).alias("k"), F.lit("2024-01-01").alias("d"), (F.col("id") % 7).alias("v"))
    split = SplitWindow(df, ["k"], ["-d", "-id"], Split(hot_rows=100))
    sizes = [r["count"] for r in split._cut.groupBy("_slot").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1500
    known = F.when(F.col("v") == 0, F.col("id"))
    got = split.last_known(known, "known").neighbour(F.col("id"), "five", 5).running(F.col("v"), "s").frame()
    w = Window.partitionBy("k").orderBy(F.desc("id"))
    want = df.withColumns({
        "known": F.last(known, True).over(w.rowsBetween(FIRST, -1)), "five": F.lead("id", 5).over(w), "s": F.sum("v").over(w.rowsBetween(FIRST, 0)),
    })
    assert same(got, want)


def test_a_column_may_use_the_one_before(facts):
    got = SplitWindow(facts, ["k"], ["d", "id"], Split(hot_rows=50)).number("n").running(F.col("n"), "s").frame()
    w = Window.partitionBy("k").orderBy("d", "id")
    want = facts.withColumn("n", F.row_number().over(w).cast("long"))
    assert same(got, want.withColumn("s", F.sum("n").over(w.rowsBetween(FIRST, 0))))
