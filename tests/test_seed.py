"""Known answers on the seed tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import seed
from conftest import rows, same
from millrace.functions import dates
from millrace.operators import aggregates as agg
from millrace.operators import changes, joins, subqueries, topk
from millrace.operators import rows as row_ops
from millrace.operators.windows import Split, SplitWindow, global_running
from millrace.plans import jobs


@pytest.fixture(scope="module")
def cust(spark):
    return seed.customers(spark).cache()


@pytest.fixture(scope="module")
def ords(spark):
    return seed.orders(spark).cache()


@pytest.fixture(scope="module")
def ups(spark):
    return seed.updates(spark).cache()


def test_filters(cust):
    assert cust.count() == 980
    assert row_ops.where_between(cust, "cust_id", 200, 500).count() == 301
    assert row_ops.where_prefix(cust, "cust_name", "Customer_1").count() == 101
    assert row_ops.where_in(cust, "city", ["hyd", "Bangalore", "Chennai"]).count() == 589
    assert row_ops.where_all(cust, [F.col("city") == "hyd", F.col("cust_id") > 500]).count() == 100
    first = topk.sort_by(row_ops.where_eq(cust, "city", "hyd"), ["signup_date", "cust_id"]).limit(3)
    assert [r["cust_name"] for r in first.collect()] == ["Customer_365", "Customer_730", "Customer_370"]


def test_city_counts(cust):
    assert {r["city"]: r["rows"] for r in agg.count_by(cust, ["city"]).collect()} == {
        "hyd": 197, "Bangalore": 196, "Chennai": 196, "Mumbai": 195, "Delhi": 196,
    }
    assert agg.rollup_count(cust, ["city"]).count() == 6


def test_joins(cust, ords):
    inner = joins.inner_join(ords, cust, "cust_id")
    assert sorted(r["order_id"] for r in inner.collect()) == [101, 102, 103, 106, 107]
    assert joins.left_join(cust, ords, "cust_id").count() == 981
    assert {r["cust_id"] for r in joins.semi_join(cust, ords, "cust_id").collect()} == {1, 2, 500, 700}
    assert joins.anti_join(cust, ords, "cust_id").count() == 976
    rich = joins.sum_having(ords, cust.select("cust_id"), "cust_id", F.col("amount"), 1000)
    assert rows(rich) == [(700, 1500.0)]
    assert agg.cube_count(joins.left_join(cust, ords, "cust_id"), ["city", "status"]).count() == 17


def test_totals(ords):
    totals = agg.multi_agg(ords, ["cust_id"], {"t": F.sum("amount"), "n": F.count("*")})
    assert {tuple(r) for r in totals.collect()} == {
        (1, 800.0, 2), (2, 750.0, 1), (5, 1200.0, 1), (10, 450.0, 1), (500, 900.0, 1), (700, 1500.0, 1),
    }
    assert {r[0]: r[1] for r in agg.avg_by(ords, ["status"], F.col("amount")).collect()} == {
        "Cancelled": 450.0, "Completed": 970.0, "Pending": 300.0,
    }
    one = ords.withColumn("g", F.lit(1))
    assert agg.median_by(one, "g", "amount", Split(F.col("amount"))).first()["median"] == 750.0
    above = subqueries.above(ords, F.col("amount"), F.avg("amount"))
    assert {r["order_id"] for r in above.collect()} == {107, 104, 106}
    assert rows(agg.count_by(ords, ["cust_id"], at_least=2)) == [(1, 2)]


def test_running_totals(ords):
    split = Split(F.col("order_date"), hot_rows=2)
    run = SplitWindow(ords, ["cust_id"], ["order_date", "order_id"], split).running(F.col("amount"), "r").frame()
    assert {r["order_id"]: r["r"] for r in run.where("cust_id = 1").collect()} == {101: 500.0, 103: 800.0}
    totals = ords.groupBy("cust_id").agg(F.sum("amount").alias("t"))
    done = global_running(totals, "t", "cust_id", slots=3)
    assert {r["cust_id"]: r["running"] for r in done.collect()} == {
        700: 1500, 5: 2700, 500: 3600, 1: 4400, 2: 5150, 10: 5600,
    }


def test_months(ords):
    report = {str(r["month"])[:7]: (r["total"], r["orders"]) for r in jobs.monthly_report(ords, "order_date", F.col("amount")).collect()}
    assert report == {"2025-01": (1550, 3), "2025-02": (2550, 3), "2025-03": (1500, 1)}


@pytest.mark.parametrize("members,left", [([1, 2, None], 0), ([1, 2], 978), ([], 980)])
def test_not_in(spark, cust, members, left):
    listed = spark.createDataFrame([(m,) for m in members], "id long")
    assert subqueries.not_in(cust, "cust_id", listed, "id").count() == left


def test_last_write_wins(ups):
    now = changes.last_write_wins(ups, "cust_id", "updated_at", "record_id")
    assert {(r["cust_id"], r["city"], str(r["updated_at"])[:10]) for r in now.collect()} == {
        (1, "Chennai", "2025-03-01"), (2, "Mumbai", "2025-02-15"), (3, "Chennai", "2025-01-05"),
    }


def test_redelivery_changes_nothing(spark, ups):
    again = seed.updates(spark, [seed.REDELIVERED])
    once = changes.apply_batches([ups, again], "cust_id", "updated_at", "record_id")
    twice = changes.apply_batches([ups, again, ups, again], "cust_id", "updated_at", "record_id")
    assert same(once, twice)
    assert {r["cust_id"]: r["city"] for r in once.collect()}[3] == "Hyderabad"


def test_late_records(spark, ups):
    late = changes.late_records(ups, seed.updates(spark, [seed.REDELIVERED]), "cust_id", "updated_at")
    assert late.count() == 3


def test_merge_takes_whole_rows(spark, ups):
    a = changes.last_write_wins(ups, "cust_id", "updated_at", "record_id")
    b = changes.last_write_wins(seed.updates(spark, [seed.REDELIVERED]), "cust_id", "updated_at", "record_id")
    merged = joins.newest(a, b, "cust_id", ["updated_at", "record_id"])
    assert same(merged, b)


def test_upsert_keeps_updates(spark, cust):
    target = cust.where("cust_id <= 3")
    incoming = spark.createDataFrame([(2, "Rahul", "Mumbai"), (4, "NewCo", "Pune")], "cust_id long, cust_name string, city string")
    out = {r["cust_id"]: r for r in changes.upsert(target, incoming, "cust_id").collect()}
    assert sorted(out) == [1, 2, 3, 4]
    assert out[2]["city"] == "Mumbai" and str(out[2]["signup_date"]) == "2024-02-15"
    assert out[4]["signup_date"] is None
    gone = changes.upsert(target, incoming.withColumn("x", F.col("cust_id") == 2), "cust_id", F.col("x"))
    assert sorted(r["cust_id"] for r in gone.collect()) == [1, 3, 4]


def test_history(spark, ups):
    # Two changes at one instant, a change that changes nothing, and a hot key.
    more = [
        (8, 1, "vikram", "Chennai", "2025-03-02 10:00:00", "UPDATE"),
        (9, 2, "Rahul", "Pune", "2025-02-15 10:00:00", "UPDATE"),
        (10, 2, "Rahul", "Delhi", "2025-02-15 18:00:00", "UPDATE"),
    ]
    log = seed.updates(spark, more)
    for hot in (2, 10**9):
        split = Split(F.to_date("updated_at"), hot_rows=hot)
        h = changes.scd2(log, "cust_id", "updated_at", "record_id", ["city"], split)
        got = {(r["cust_id"], r["city"], str(r["valid_from"]), str(r["valid_to"]), r["is_current"]) for r in h.collect()}
        assert got == {
            (1, "hyd", "2025-01-01 10:00:00", "2025-02-01 10:00:00", False),
            (1, "Bangalore", "2025-02-01 10:00:00", "2025-03-01 10:00:00", False),
            (1, "Chennai", "2025-03-01 10:00:00", "None", True),
            (2, "Bangalore", "2025-01-10 10:00:00", "2025-02-15 10:00:00", False),
            (2, "Pune", "2025-02-15 10:00:00", "2025-02-15 18:00:00", False),
            (2, "Delhi", "2025-02-15 18:00:00", "None", True),
            (3, "Chennai", "2025-01-05 10:00:00", "None", True),
        }


def test_point_in_time(spark, ups):
    h = changes.scd2(ups, "cust_id", "updated_at", "record_id", ["city"], Split(F.col("updated_at")))
    facts = spark.createDataFrame(
        [(1, 1, "2024-12-31 00:00:00"), (2, 1, "2025-02-01 10:00:00"), (3, 1, "2025-02-20 00:00:00"), (4, 9, "2025-02-20 00:00:00")],
        "id int, cust_id long, at string",
    ).withColumn("at", F.col("at").cast("timestamp_ntz"))
    for hot in (2, 10**9):
        found = changes.as_of(h, facts, "cust_id", "at", Split(F.to_date("_ts"), hot_rows=hot), ["city"])
        assert {r["id"]: r["city"] for r in found.collect()} == {1: None, 2: "Bangalore", 3: "Bangalore", 4: None}


def test_dates(spark):
    df = spark.createDataFrame([("2025-01-31", "2025-02-28"), ("2025-03-10", "2025-01-19")], "a string, b string")
    d = df.select(F.col("a").cast("date").alias("a"), F.col("b").cast("date").alias("b"))
    assert [str(r["moved"]) for r in dates.add_time(d, "a", months=1).collect()] == ["2025-02-28", "2025-04-10"]
    assert [r["months"] for r in dates.months_between_cols(d, "a", "b").collect()] == [-1.0, 1.70967742]
    texts = spark.createDataFrame([("2025-01-10",), ("01/15/2025",), ("not-a-date",)], "v string")
    parsed = dates.parse_date(texts, "v", ["yyyy-MM-dd", "MM/dd/yyyy"])
    assert [str(r["date"]) for r in parsed.collect()] == ["2025-01-10", "2025-01-15", "None"]
    zoned = dates.to_zone(spark.sql("SELECT TIMESTAMP_NTZ '2025-02-17 00:00:00' AS t"), "t", "Asia/Kolkata", "UTC")
    assert str(zoned.first()["local"]) == "2025-02-16 18:30:00"
    assert dates.stamp(spark.range(100).repartition(5)).select("run_at").distinct().count() == 1
