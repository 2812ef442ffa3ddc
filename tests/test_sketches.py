from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from millrace.operators import sketches
from millrace.plans import jobs
from millrace.sources.versions import VersionedTable


def events(spark, first, last, users):
    """A third of all rows has one user and one value; some have none."""
    n = F.col("id")
    user = F.when(n % 3 == 0, 0).when(n % 50 != 7, n % users)
    value = F.when(n % 3 == 0, 5.0).when(n % 50 != 9, (n * 37 % 1000).cast("double"))
    day = F.date_add(F.lit(date(2024, 1, 1)), (n % 60).cast("int"))
    return spark.range(first, last).select(user.alias("user_id"), F.when(n % 90 != 1, day).cast("timestamp").alias("ts"), value.alias("value"))


def test_states_of_batches_merge_to_those_of_all_rows(spark, new_path):
    parts = [events(spark, 0, 9000, 700), events(spark, 6000, 12_000, 900), events(spark, 12_000, 20_000, 1500)]
    table = VersionedTable.create(jobs.daily_states(parts[0], "user_id", "ts", "value"), new_path(), ["day"])
    for number, part in [(0, parts[1]), (0, parts[1]), (1, parts[2])]:
        sketches.fold_states(table, jobs.daily_states(part, "user_id", "ts", "value"), ["day"], jobs.STATE_KINDS, ("feed", number))
    assert table.numbers() == [1, 2, 3]
    everything = parts[0].unionByName(parts[1]).unionByName(parts[2])
    got = {r["month"]: r for r in jobs.monthly_from_states(table.read(), 0.5).collect()}
    month = F.trunc("ts", "month").alias("month")
    want = everything.groupBy(month).agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("users")).collect()
    assert len(got) == len(want) == 3
    for r in want:
        mine = got[r["month"]]
        assert mine["events"] == r["n"] and abs(mine["users"] - r["users"]) <= 4 * 1.04 / 2**7 * r["users"] + 1
        values = everything.select(month, "value").where(F.col("month").eqNullSafe(F.lit(r["month"])) & F.col("value").isNotNull())
        below = values.where(F.col("value") < mine["quantile"]).count() / values.count()
        upto = values.where(F.col("value") <= mine["quantile"]).count() / values.count()
        assert below <= 0.5 + 0.01 and upto >= 0.5 - 0.01


def test_months_are_read_from_states(spark, new_path):
    table = VersionedTable.create(jobs.daily_states(events(spark, 0, 500, 20), "user_id", "ts", "value"), new_path(), ["day"])
    plan = plan_of(jobs.monthly_from_states(table.read(), 0.5))
    assert "ReadSchema: struct<day:date,events:bigint,users:binary,values:binary>" in plan and "Range" not in plan


def test_states_of_nothing(spark):
    none = jobs.daily_states(events(spark, 0, 0, 5), "user_id", "ts", "value")
    assert none.collect() == [] and jobs.monthly_from_states(none, 0.5).collect() == []
    only_nulls = spark.range(3).select(F.lit(None).cast("long").alias("user_id"), F.lit(None).cast("timestamp").alias("ts"), F.lit(None).cast("double").alias("value"))
    row = jobs.monthly_from_states(jobs.daily_states(only_nulls, "user_id", "ts", "value"), 0.5).first()
    assert (row["month"], row["events"], row["users"], row["quantile"]) == (None, 3, 0, None)


@pytest.mark.parametrize("log2", [10, 14])
def test_a_larger_state_is_closer(spark, log2):
    n = spark.range(50_000).agg(sketches.estimated_distinct(sketches.distinct_state("id", log2)).alias("n")).first()["n"]
    assert abs(n - 50_000) <= 4 * 1.04 / 2 ** (log2 / 2) * 50_000
