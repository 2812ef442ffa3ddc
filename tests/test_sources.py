from __future__ import annotations

import glob

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, same
from millrace.session import shared_path
from millrace.sources import files, keyed
from millrace.sources import tables as catalog


def parts(path, kind="parquet"):
    return glob.glob(f"{path.removeprefix('file:')}/**/part-*.{kind}", recursive=True)


def test_filter_and_projection_reach_the_scan(spark, tables):
    df = files.filtered_scan(spark, f"{tables.folder}/lineitem.parquet", F.col("l_quantity") > 45.0, ["l_orderkey"])
    plan = plan_of(df)
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,45.0)]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


def test_partitions_are_pruned(spark, tables, new_path):
    path = new_path()
    files.write_parquet(tables["events"].withColumn("day", F.to_date("ts")), path, ["day"])
    assert len(parts(path)) == 30  # one file per day
    df = files.pruned_scan(spark, path, F.col("day") == "2024-01-03")
    plan = plan_of(df)
    assert "PartitionFilters: [isnotnull(day" in plan
    assert df.select("_metadata.file_path").distinct().count() == 1


def test_dynamic_overwrite_keeps_other_partitions(spark, tables, new_path):
    path = new_path()
    orders = tables.ord.select("order_id", "amount", "status")
    files.write_parquet(orders, path, ["status"])
    before = set(parts(f"{path}/status=Completed"))
    files.overwrite_partitions(orders.where("status = 'Pending'").limit(3), path, ["status"])
    assert set(parts(f"{path}/status=Completed")) == before
    assert spark.read.parquet(path).where("status = 'Pending'").count() == 3


def test_file_counts(spark, tables, new_path):
    path, few = new_path(), new_path()
    files.write_sized(tables.ord, path, 100)
    assert len(parts(path)) >= 15
    assert spark.read.parquet(path).groupBy("_metadata.file_path").count().where("count > 100").isEmpty()
    files.compact(spark, path, few, file_bytes=files.folder_bytes(spark, path) // 3)
    assert len(parts(few)) in (3, 4)
    assert same(spark.read.parquet(few), tables.ord)


def test_rejects_are_kept(spark, new_path):
    path = new_path()
    spark.createDataFrame([("id,v",), ("1,2.5",), ("x,1.0",), ("3,abc",), ("4,",)], "value string").coalesce(1).write.text(path)
    good, bad = files.read_with_rejects(spark, path, "id int, v double")
    assert good.count() == 2 and bad.count() == 2
    assert sorted(r["line"] for r in bad.collect()) == ["3,abc", "x,1.0"]


def test_json_reader_options(spark, new_path):
    path = new_path()
    spark.createDataFrame([('{"a": 1,\n "d": "05/02/2025"}',)], "value string").coalesce(1).write.text(path)
    row = files.read_json(spark, path, "a int, d date", multiline=True, date_format="dd/MM/yyyy").first()
    assert row["a"] == 1 and str(row["d"]) == "2025-02-05"


def test_merged_schemas(spark, new_path):
    path = new_path()
    spark.range(2).write.parquet(f"{path}/v=1")
    spark.range(2, 4).withColumn("extra", F.lit("new")).write.parquet(f"{path}/v=2")
    got = files.read_merged(spark, path, {"extra": F.lit("old")})
    assert sorted((r["id"], r["extra"]) for r in got.collect()) == [(0, "old"), (1, "old"), (2, "new"), (3, "new")]


def test_bucketed_tables_need_no_exchange(spark, tables):
    names = ["bucketed_heads", "bucketed_lines"]
    catalog.write_bucketed(tables["orders"].select(F.col("o_orderkey").alias("k"), "o_totalprice"), names[0], 4, ["k"])
    catalog.write_bucketed(tables["lineitem"].select(F.col("l_orderkey").alias("k"), "l_quantity"), names[1], 4, ["k"])
    joined = catalog.bucketed_join(spark, *names, "k")
    plan = plan_of(joined)
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    assert "Exchange" not in plan_of(spark.table(names[1]).groupBy("k").count())
    plain = spark.read.parquet(f"{tables.folder}/lineitem.parquet").count()
    assert joined.count() == plain
    for name in names:
        catalog.drop_table(spark, name)


def test_catalog_profile(spark, tables):
    catalog.ctas(spark, "profiled", tables["nation"])
    seen = catalog.catalog_profile(spark).where("table = 'profiled'")
    assert {(r["column"], r["type"]) for r in seen.collect()} == {
        ("n_nationkey", "int"), ("n_name", "string"), ("n_regionkey", "int"),
    }
    catalog.drop_table(spark, "profiled")
    assert not spark.catalog.tableExists("profiled")


def test_save_modes(spark, tables, new_path):
    path = new_path()
    files.write_orc(tables["region"], path)
    files.write_orc(tables["region"], path, mode="append")
    assert files.read_orc(spark, path).count() == 10
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        files.write_orc(tables["region"], path, mode="error")


def test_shared_paths_are_new(spark):
    assert shared_path(spark, "a") != shared_path(spark, "a")


def test_upsert_rewrites_only_touched_parts(spark, tables, new_path):
    path = new_path()
    target = tables.cust.select("cust_id", "cust_name", "city")
    keyed.write_keyed(target, path, "cust_id", 8)
    before = set(parts(path))
    incoming = spark.createDataFrame([(5, "new name"), (-1, "inserted")], "cust_id long, cust_name string")
    keyed.upsert_keyed(path, incoming, "cust_id", 8)
    assert len(before - set(parts(path))) in (1, 2)
    rows = {r["cust_id"]: r for r in keyed.read_keyed(spark, path).collect()}
    old = {r["cust_id"]: r for r in target.collect()}
    assert len(rows) == len(old) + 1
    assert rows[5]["cust_name"] == "new name" and rows[5]["city"] == old[5]["city"]
    assert rows[-1]["city"] is None
    assert all(rows[k] == v for k, v in old.items() if k != 5)
    # A second delivery of the same batch changes nothing.
    keyed.upsert_keyed(path, incoming, "cust_id", 8)
    assert {r["cust_id"]: r for r in keyed.read_keyed(spark, path).collect()} == rows
