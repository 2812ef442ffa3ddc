from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows, same
from millrace.operators import joins, skew


@pytest.fixture(scope="module")
def sides(tables):
    large = tables.hot.select("k", "l_orderkey", "l_linenumber", "l_quantity")
    large = large.withColumn("k", F.when(F.col("l_linenumber") != 7, F.col("k")))  # some null keys
    small = tables["part"].select(F.col("p_partkey").alias("k"), "p_brand").where("p_partkey % 10 <> 3")
    return large, small.unionByName(small.where("k % 4 = 0"))  # repeated keys


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_is_the_plain_join(sides, how):
    large, small = sides
    salted = skew.salted_join(large, small, "k", ["l_orderkey", "l_linenumber"], salts=7, how=how)
    assert same(salted, large.join(small, "k", how))


@pytest.mark.parametrize("limit", [0, 1000])
def test_split_join_is_the_plain_join(sides, limit):
    large, small = sides
    split = skew.split_hot_join(large, small, "k", ["l_orderkey", "l_linenumber"], rows=limit)
    assert same(split, large.join(small, "k"))


def test_salts_do_not_change_between_runs(sides):
    salt = skew.row_salt(["l_orderkey", "l_linenumber"], 8)
    once = sides[0].withColumn("s", salt)
    assert same(once, sides[0].repartition(3).withColumn("s", salt))
    assert {r[0] for r in once.select("s").distinct().collect()} == set(range(8))


def test_hot_keys_are_bounded(sides):
    hot = skew.hot_keys(sides[0], "k", 0.05)
    found = hot.collect()
    assert [r["k"] for r in found] == [0] or {r["k"] for r in found} == {0, None}
    assert len(found) <= 20


def test_broadcast_only_when_small(sides):
    large, small = sides
    assert skew.small_enough(small, 1000) and not skew.small_enough(large, 1000)
    assert "BroadcastHashJoin" in plan_of(skew.broadcast_join(large, small, "k", rows=1000))
    spark = large.sparkSession
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan_of(skew.broadcast_join(large, small, "k", rows=10))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_join_strategies(sides):
    large, small = sides
    assert "SortMergeJoin" in plan_of(joins.merge_join(large, small, "k"))
    assert "ShuffledHashJoin" in plan_of(joins.hash_join(large, small, "k"))


def test_interval_join_is_the_range_join(tables):
    e = tables["events"].select("user_id", "event_id", "ts")
    a = e.select("user_id", F.col("event_id").alias("x"), F.col("ts").alias("a_ts"))
    b = e.select("user_id", F.col("event_id").alias("y"), F.col("ts").alias("b_ts"))
    got = joins.interval_join(a, b, "user_id", "a_ts", "b_ts", 7200).select("x", "y")
    want = a.join(b, "user_id").where("a_ts <= b_ts AND b_ts <= a_ts + INTERVAL 2 HOURS").select("x", "y")
    assert got.count() == want.count() and same(got, want)


def test_group_total_with_null_keys(sides):
    got = skew.with_group_total(sides[0], ["k"], n=F.count("*"))
    assert got.count() == sides[0].count()
    assert rows(got.where("k IS NULL").select("n").distinct())[0][0] == sides[0].where("k IS NULL").count()


def test_joins_without_hot_keys_are_plain(sides):
    large, small = sides
    even = large.where("k <> 0")
    salted = skew.salted_join(even, small, "k", ["l_orderkey"], share=0.2)
    assert "_salt" not in plan_of(salted) and same(salted, even.join(small, "k"))
    split = skew.split_hot_join(even, small, "k", ["l_orderkey"], share=0.2)
    assert "LeftAnti" not in plan_of(split) and same(split, even.join(small, "k"))
