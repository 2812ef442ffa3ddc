"""Inputs that the tables never hold: nulls, deletes, replays, repeated keys, wrong parameters."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows
from millrace.operators import changes, hierarchy, joins, skew, topk
from millrace.operators import windows as win
from millrace.operators.windows import Split
from millrace.plans import jobs
from millrace.sources import files, keyed
from pyspark.sql import functions as F

D = dt.date(2024, 1, 1)
T0 = dt.datetime(2024, 1, 1)


def test_recent_total_keeps_rows_without_key_or_day(spark):
    df = spark.createDataFrame([("a", D, 1), (None, D, 2), ("a", None, 4), ("a", None, 8)], "k string, d date, v int")
    got = win.recent_total(df, ["k"], "d", F.col("v"), 30, "s")
    assert rows(got.select("k", "d", "s")) == rows(spark.createDataFrame([("a", D, 1), (None, D, 2), ("a", None, 12), ("a", None, 12)], "k string, d date, s long"))


def test_keyed_table_refuses_other_parts(spark, new_path):
    path = new_path()
    keyed.write_keyed(spark.range(20).withColumn("v", F.lit(1)), path, "id", 4)
    with pytest.raises(ValueError, match="into 4 parts"):
        keyed.upsert_keyed(path, spark.range(5).withColumn("v", F.lit(2)), "id", 7)
    keyed.upsert_keyed(path, spark.range(5, 25).withColumn("v", F.lit(2)), "id")
    keyed.upsert_keyed(path, spark.range(1).withColumn("v", F.lit(3)), "id", 4)
    assert keyed.read_keyed(spark, path).agg(F.count("*"), F.sum("v")).first() == (25, 4 + 40 + 3)


def test_summary_keeps_the_stored_total_of_rows_without_a_day(spark, new_path):
    path, schema = new_path(), "day date, kind string, n long"
    spark.createDataFrame([(None, "x", 5), (D, "x", 1)], schema).write.partitionBy("day").parquet(path)
    jobs.add_to_summary(path, spark.createDataFrame([(None, "x", 2)], schema), ["day", "kind"], ["n"], "day")
    assert rows(spark.read.parquet(path).select("day", "kind", "n")) == rows(spark.createDataFrame([(None, "x", 7), (D, "x", 1)], schema))


@pytest.mark.parametrize("hot", [None, 1])
def test_history_of_changes_without_a_time(spark, hot):
    log = spark.createDataFrame([(1, None, 1, "p"), (1, None, 2, "q"), (1, T0, 3, "r"), (2, T0, 4, "s")], "k int, ts timestamp_ntz, n int, c string")
    got = changes.scd2(log, "k", "ts", "n", ["c"], Split(F.col("ts"), hot_rows=hot)).select("k", "c", "valid_from", "valid_to", "is_current")
    assert rows(got) == rows(spark.createDataFrame(
        [(1, "q", None, T0, False), (1, "r", T0, None, True), (2, "s", T0, None, True)], "k int, c string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean"
    ))


@pytest.mark.parametrize("hot", [None, 1])
def test_lookup_after_a_delete_finds_nothing(spark, hot):
    day = dt.timedelta(days=1)
    history = spark.createDataFrame([(1, "p", None, T0), (1, "q", T0, T0 + day), (2, "r", T0, None)], "k int, c string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    facts = spark.createDataFrame([(1, 1, T0 - day), (2, 1, T0), (3, 1, T0 + day), (4, 1, T0 + 30 * day), (5, 2, T0 + 30 * day), (6, 2, None), (7, 9, T0)], "f int, k int, at timestamp_ntz")
    found = changes.as_of(history, facts, "k", "at", Split(F.col("_ts"), hot_rows=hot), ["c"])
    assert {r["f"]: r["c"] for r in found.collect()} == {1: "p", 2: "q", 3: None, 4: None, 5: "r", 6: None, 7: None}


def test_repeated_keys_in_a_batch_are_refused(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    twice = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    for change in (changes.upsert, changes.scd1):
        with pytest.raises(Exception, match="more than once"):
            change(target, twice, "k").collect()
    assert rows(changes.upsert(target, twice.limit(1), "k")) == [(1, "x"), (2, "b")]


def test_salted_join_kinds_and_salts(spark):
    large, small = spark.createDataFrame([(1, 1), (2, 1)], "id int, k int"), spark.createDataFrame([(1,), (2,)], "k int")
    for how in ("right", "full", "full_outer"):
        with pytest.raises(ValueError, match="how must be"):
            skew.salted_join(large, small, "k", ["id"], how=how)
    assert rows(skew.salted_join(large, small, "k", ["id"])) == [(1, 1), (1, 2)]
    assert [skew.pieces(n) for n in (10, 16_000_000, 16_000_001, 10**9)] == [16, 16, 17, 1000]
    assert [win.slot_count(n) for n in (10, 10**12)] == [200, 100_000]


def test_fanout_of_keys_beyond_a_long(spark):
    df = spark.createDataFrame([(1, 5 * 10**9)], "k int, c long")
    product = df.select(F.sum(F.col("c").cast("decimal(19,0)") * F.col("c").cast("decimal(19,0)")).cast("decimal(38,0)")).first()[0]
    assert int(product) == 25 * 10**18
    assert joins.fanout_report(df, df, "k").schema["joined_rows"].dataType.simpleString() == "decimal(38,0)"


def test_roots_without_a_parent(spark):
    edges = spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, None), (5, 9)], "n int, p int")
    want = {1: 0, 2: 1, 3: 2, 4: 0}
    assert {r["node"]: r["level"] for r in hierarchy.walk(edges, "n", "p", None).collect()} == want
    assert {r["node"]: r["level"] for r in hierarchy.walk(edges, "n", "p", F.col("p").isNull() & (F.col("n") < 9)).collect()} == want


def test_files_of_different_types_and_folders(spark, new_path):
    path, few = new_path(), new_path()
    spark.range(3).select(F.col("id").cast("int").alias("id"), F.lit("a").alias("p")).write.partitionBy("p").parquet(f"{path}/x=1")
    spark.range(10**10, 10**10 + 2).select("id", F.lit("b").alias("p")).write.partitionBy("p").parquet(f"{path}/x=2")
    merged = files.read_merged(spark, path, {}, "id long, p string, x int")
    assert rows(merged.select("id", "p")) == sorted([(0, "a"), (1, "a"), (2, "a"), (10**10, "b"), (10**10 + 1, "b")], key=lambda r: (str(r[0]), r[1]))
    source = new_path()
    merged.write.partitionBy("p").parquet(source)
    files.compact(spark, source, few, partitions=["p"])
    assert rows(spark.read.parquet(f"{few}/p=b").select("id")) == [(10**10,), (10**10 + 1,)]


def test_early_limit_beyond_a_thousand(spark):
    from conftest import plan_of

    assert "WindowGroupLimit" in plan_of(topk.top_n_per_key(spark.range(10_000).withColumn("k", F.col("id") % 2), ["k"], ["id"], 1500))


def test_upsert_inserts_every_row_without_a_key(spark):
    target = spark.createDataFrame([(1, "a", 5), (None, "t", 6)], "k int, v string, n int")
    batch = spark.createDataFrame([(None, "x", False), (None, "y", False), (None, "z", True), (1, "b", False)], "k int, v string, gone boolean")
    want = [(None, "t", 6), (None, "x", None), (None, "y", None), (1, "b", 5)]
    assert sorted(map(str, rows(changes.upsert(target, batch, "k", F.col("gone"))))) == sorted(map(str, want))
    assert rows(changes.scd1(target, batch, "k")) == rows(spark.createDataFrame([(None, "t", 6), (1, "b", 5)], "k int, v string, n int"))
