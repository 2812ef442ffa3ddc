"""Edge cases the test tables do not have."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import seed
from conftest import plan_of, rows, same
from millrace.functions import nested, udfs
from millrace.operators import aggregates as agg
from millrace.operators import hierarchy, joins, layout, quality, sets, subqueries, topk
from millrace.operators import rows as row_ops
from millrace.session import sizing


def test_walk(spark):
    edges = seed.tree(spark)
    got = {r["node"]: (r["level"], r["path"]) for r in hierarchy.walk(edges, "emp_id", "mgr_id", -1).collect()}
    assert got == {1: (0, "1"), 2: (1, "1/2"), 3: (1, "1/3"), 4: (2, "1/2/4"), 5: (2, "1/2/5"), 6: (3, "1/2/4/6")}
    assert same(hierarchy.walk_sql(spark, edges, "emp_id", "mgr_id", -1), hierarchy.walk(edges, "emp_id", "mgr_id", -1))
    assert hierarchy.levels_fixed(edges, "emp_id", "mgr_id", -1, 2).count() == 3


def test_walk_ends_on_cycles(spark):
    # 6 also reports to nobody known; 1 reports to 6, which closes a cycle; 8 and 9 form one of their own.
    edges = seed.tree(spark, [(1, 6), (8, 9), (9, 8), (5, 3)])
    got = hierarchy.walk(edges, "emp_id", "mgr_id", -1)
    assert sorted(r["node"] for r in got.collect()) == [1, 2, 3, 4, 5, 6]


def test_walk_deep_chain(spark):
    chain = spark.range(24).select(F.col("id").alias("n"), (F.col("id") - 1).alias("p"))
    got = hierarchy.walk(chain, "n", "p", -1)
    assert got.count() == 24 and got.agg(F.max("level")).first()[0] == 23
    with pytest.raises(ValueError):
        hierarchy.walk(chain, "n", "p", -1, max_depth=3)


def test_except_keeps_duplicates_and_matches_nulls(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "x int")
    b = spark.createDataFrame([(2,), (None,)], "x int")
    assert rows(sets.except_rows(a, b)) == [(1,)]
    assert rows(sets.except_rows(a, b, keep_duplicates=True)) == [(1,), (1,)]


def test_null_join_modes(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b")], "k int, lv string")
    right = spark.createDataFrame([(1, "x"), (None, "y"), (0, "z")], "rk int, rv string")
    assert [joins.join_nulls(left, right, "k", "rk", m, 0).count() for m in ("drop", "safe", "sentinel")] == [1, 2, 2]


def test_correlated_count_is_zero(spark):
    outer = spark.range(2).union(spark.range(5, 6)).withColumnRenamed("id", "k")
    inner = spark.createDataFrame([(1, 10), (1, 20)], "k long, v int")
    got = subqueries.correlated(outer, inner, "k", {"n": F.count("*"), "top": F.max("v")}, zero=["n"])
    assert rows(got) == [(0, 0, None), (1, 2, 20), (5, 0, None)]


def test_rejects_name_their_rules(spark):
    df = spark.createDataFrame([(1, 5), (None, 5), (None, -1)], "id int, v int")
    good, bad = quality.validate(df, {"id": F.col("id").isNotNull(), "v": F.col("v") > 0})
    assert good.count() == 1
    assert sorted(r["broken"] for r in bad.collect()) == [["id"], ["id", "v"]]


def test_mean_default_without_values(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", None)], "k string, v double")
    assert rows(udfs.mean_or(df, ["k"], F.col("v"), -1)) == [("a", 2.0), ("b", -1.0)]
    by_udaf = df.groupBy("k").agg(udfs.mean_udaf("v").alias("m"))
    assert rows(by_udaf) == [("a", 2.0), ("b", -1.0)]


def test_json_that_is_not_json(spark):
    df = spark.createDataFrame([('{"k": 3}',), ("oops",), (None,)], "j string")
    assert [r["k"] for r in nested.json_fields(df, "j", "k int", {"k": "k"}).collect()] == [3, None, None]


def test_observed_counts(spark):
    df, seen = agg.observed(spark.range(100), {"even": F.col("id") % 2 == 0})
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"even": 50}


def test_where_false_reads_nothing(tables):
    assert "LocalTableScan <empty>" in plan_of(row_ops.where_false(tables.ord))


def test_rank_limit_comes_before_the_shuffle(tables):
    plan = plan_of(topk.best_per_key(tables.ord, ["cust_id"], ["-amount", "order_id"]))
    below = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in below


def test_partitions(spark):
    df = spark.range(1000)
    assert layout.repartition_by(df, 5).rdd.getNumPartitions() == 5
    assert layout.shrink(layout.repartition_by(df, 6, ["id"]), 2).rdd.getNumPartitions() == 2
    profile = layout.partition_profile(layout.repartition_by(df, 4))
    assert profile.agg(F.sum("rows")).first()[0] == 1000 and profile.count() == 4
    ranges = sorted(tuple(r) for r in layout.range_profile(df, "id", 4).collect())
    assert all(a[3] < b[2] for a, b in zip(ranges, ranges[1:]))
    assert topk.range_sort(df, "id", 4).select("id").rdd.glom().map(lambda p: [r[0] for r in p] == sorted(r[0] for r in p)).min()


def test_reuse_is_cached_and_released(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    with subqueries.reused(df) as kept:
        assert "InMemoryTableScan" in plan_of(kept.where("x > 3"))
    assert not df.is_cached


def test_two_pass_top_n(tables):
    one = topk.top_n_per_key(tables.ord, ["status"], ["-amount", "order_id"], 7)
    assert same(one, topk.top_n_two_pass(tables.ord, ["status"], ["-amount", "order_id"], 7, ["order_id"], 5))


def test_incremental_equals_recompute(tables):
    def totals(df):
        return df.groupBy("cust_id").agg(F.count("*").alias("n"), F.sum(agg.money("amount")).alias("t"))

    merged = totals(tables.ord.where("order_id % 5 = 0"))
    for r in range(1, 5):
        merged = agg.merge_aggregate(merged, totals(tables.ord.where(f"order_id % 5 = {r}")), ["cust_id"], ["n", "t"])
    assert same(merged.select("cust_id", "n", F.col("t").cast("double").alias("t")),
                totals(tables.ord).withColumn("t", F.col("t").cast("double")))


@pytest.mark.parametrize("ties", ["rank", "dense_rank"])
def test_top_ties(tables, ties):
    # Coarse sizes, so that most rows tie, and a null key.
    df = tables["part"].select(
        "p_partkey", F.when(F.col("p_partkey") % 5 != 0, F.col("p_brand")).alias("k"), F.floor(F.col("p_size") / 10).alias("s")
    )
    one = topk.top_n_per_key(df, ["k"], ["-s"], 4, ties)
    assert same(one, topk.top_ties_per_key(df, ["k"], ["-s"], 4, ties, ["p_partkey"], salts=3))


def test_sizing():
    small, large = sizing(1 << 30), sizing(100 << 40)
    assert small["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == "200"
    assert large["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == "100000"
    assert int(large["spark.sql.files.maxPartitionBytes"]) == 512 << 20
