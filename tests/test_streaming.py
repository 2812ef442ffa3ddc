"""Late data, restarts and replays, on files that arrive one by one."""

from __future__ import annotations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import rows, same
from millrace.streaming import events as stream
from millrace.streaming import runs

SCHEMA = "event_id long, user_id long, ts timestamp, value double"


@pytest.fixture
def feed(spark, new_path):
    """A folder, a way to add a file of (id, user, 'HH:MM', value), and its stream."""
    folder = new_path("feed")

    def add(*events):
        data = [(i, u, f"2024-01-01 {at}:00", float(v)) for i, u, at, v in events]
        df = spark.createDataFrame(data, "event_id long, user_id long, ts string, value double")
        df.withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(folder)

    return folder, add, lambda: stream.read_events(spark, folder, SCHEMA, "ts")


def hourly(df):
    return stream.tumbling(stream.with_lateness(df, "ts", "10 minutes"), "ts", "1 hour", {"n": F.count("*")})


def test_late_rows_are_dropped_and_reported(spark, feed, new_path):
    _, add, events = feed
    out, state = new_path(), new_path()
    add((1, 1, "00:10", 1), (2, 1, "03:00", 1))
    runs.run_to_files(hourly(events()), out, state)
    add((3, 1, "00:20", 1), (4, 1, "06:00", 1))
    query = runs.run_to_files(hourly(events()), out, state)
    got = {str(r["start"])[11:16]: r["n"] for r in spark.read.parquet(out).collect()}
    assert got == {"00:00": 1, "03:00": 1}  # 00:20 came too late, 06:00 is still open
    report = runs.state_report(query)
    assert report.agg(F.sum("dropped_late")).first()[0] == 1
    assert report.agg(F.max("rows")).first()[0] >= 1


def test_restart_gives_each_row_once(spark, feed, new_path):
    _, add, events = feed
    out, state = new_path(), new_path()
    add((1, 1, "00:10", 1), (2, 2, "00:20", 2))
    runs.run_to_files(events(), out, state)
    runs.run_to_files(events(), out, state)
    add((3, 1, "00:30", 3))
    runs.run_to_files(events(), out, state)
    assert sorted(r["event_id"] for r in spark.read.parquet(out).collect()) == [1, 2, 3]


def test_dedup_within_watermark(spark, feed, new_path):
    _, add, events = feed
    out, state = new_path(), new_path()

    def once():
        return stream.stream_dedup(stream.with_lateness(events(), "ts", "1 hour"), ["event_id"])

    add((1, 1, "00:10", 1), (1, 1, "00:10", 1))
    runs.run_to_files(once(), out, state)
    add((1, 1, "00:10", 1), (2, 1, "00:15", 1))
    runs.run_to_files(once(), out, state)
    assert sorted(r["event_id"] for r in spark.read.parquet(out).collect()) == [1, 2]


def test_upsert_replay_changes_nothing(spark, feed, new_path):
    _, add, events = feed
    target = new_path()
    add((1, 1, "00:10", 1), (2, 2, "00:20", 2), (3, 1, "00:30", 3))
    runs.stream_upsert(events(), target, new_path(), "user_id", "ts", "event_id")
    first = rows(runs.upserted(spark, target, "user_id", "ts", "event_id").select("user_id", "event_id"))
    # A new checkpoint replays the same batch over the same folder.
    runs.stream_upsert(events(), target, new_path(), "user_id", "ts", "event_id")
    assert rows(runs.upserted(spark, target, "user_id", "ts", "event_id").select("user_id", "event_id")) == first
    assert first == [(1, 3), (2, 2)]


def test_update_and_complete_modes(spark, feed, new_path):
    _, add, events = feed

    def totals():
        return events().groupBy("user_id").agg(F.count("*").alias("n"))

    out = {m: (new_path(), new_path()) for m in ("update", "complete")}
    for batch in ([(1, 1, "00:10", 1), (2, 2, "00:20", 1)], [(3, 1, "00:30", 1)]):
        add(*batch)
        for mode, (path, state) in out.items():
            runs.run_mode(totals(), mode, path, state)
    assert rows(runs.latest_updates(spark, out["update"][0], "user_id")) == [(1, 2), (2, 1)]
    assert rows(runs.latest_complete(spark, out["complete"][0])) == [(1, 2), (2, 1)]


@pytest.mark.parametrize("ttl", [None, 3_600_000])
def test_running_state_carries_over(spark, feed, new_path, ttl):
    _, add, events = feed
    out, state = new_path(), new_path()
    with stream.rocksdb_state(spark):
        for batch in ([(1, 1, "00:10", 1), (2, 2, "00:20", 5)], [(3, 1, "00:30", 2), (4, 1, "00:40", 4)]):
            add(*batch)
            runs.run_mode(stream.running_state(events(), "user_id", "value", "event_id", 3, ttl), "update", out, state)
    got = stream.combine_shards(spark.read.parquet(out), "user_id")
    assert rows(got) == [(1, 3, 7.0), (2, 1, 5.0)]


def test_running_state_is_kept_once_per_key(spark, feed, new_path):
    _, add, events = feed
    add(*[(k, k % 2, "00:10", 1) for k in range(100)])
    out = new_path()
    with stream.rocksdb_state(spark):
        query = runs.run_mode(stream.running_state(events(), "user_id", "value", "event_id"), "update", out, new_path())
    assert runs.state_report(query).agg(F.max("rows")).first()[0] == 2
    assert rows(stream.combine_shards(spark.read.parquet(out), "user_id")) == [(0, 50, 50.0), (1, 50, 50.0)]


def test_partial_totals_spread_hot_keys_and_keep_nulls():
    n = stream.HOT_ROWS
    keys, shards = pa.array([7] * n + [None, 8], pa.int64()), pa.array([5] * (n + 2), pa.int64())
    values = pa.array([0.5] * n + [2.0, None], pa.float64())
    batch = pa.RecordBatch.from_arrays([keys, shards, values], names=["user_id", "shard", "value"])
    got = [tuple(r.values()) for part in stream._partial_totals(iter([batch])) for r in part.to_pylist()]
    assert got == [(7, 5, n, n / 2), (None, 0, 1, 2.0), (8, 0, 1, None)]


def test_stream_join_equals_batch(spark, feed, new_path):
    _, add, events = feed
    add((1, 1, "00:10", 1), (2, 1, "00:50", 1), (3, 2, "01:00", 1))
    add((4, 1, "01:05", 1), (5, 2, "01:59", 1), (6, 2, "02:01", 1))

    def sides(df):
        df = stream.with_lateness(df, "ts", "3 hours")
        return (
            df.select("user_id", F.col("event_id").alias("x"), F.col("ts").alias("a_ts")),
            df.select("user_id", F.col("event_id").alias("y"), F.col("ts").alias("b_ts")),
        )

    a, _ = sides(events())
    _, b = sides(events())
    out = new_path()
    runs.run_to_files(stream.stream_interval_join(a, b, "user_id", "a_ts", "b_ts", 3600).select("x", "y"), out, new_path())
    assert rows(spark.read.parquet(out).where("x <> y")) == [(1, 2), (1, 4), (2, 4), (3, 5), (5, 6)]


def test_sliding_windows_in_batch(spark, feed):
    folder, add, _ = feed
    add((1, 1, "00:10", 1), (2, 1, "00:40", 1))
    got = stream.sliding(spark.read.parquet(folder), "ts", "1 hour", "30 minutes", {"n": F.count("*")})
    assert sorted((str(r["start"])[11:16], r["n"]) for r in got.collect()) == [("00:00", 2), ("00:30", 1), ("23:30", 1)]


def test_sessions_in_batch(spark, feed):
    folder, add, _ = feed
    add((1, 1, "00:10", 1), (2, 1, "00:30", 1), (3, 1, "02:00", 1))
    got = stream.sessions(spark.read.parquet(folder), "user_id", "ts", "30 minutes", {"n": F.count("*")})
    assert sorted(r["n"] for r in got.collect()) == [1, 2]


def test_same_as_batch(spark, feed, new_path):
    folder, add, events = feed
    add((1, 1, "00:10", 1), (2, 2, "00:20", 1))
    dim = spark.createDataFrame([(1, "a")], "user_id long, name string")
    out = new_path()
    runs.run_to_files(stream.enrich(events(), dim, "user_id"), out, new_path())
    batch = stream.enrich(spark.read.parquet(folder), dim, "user_id")
    assert same(spark.read.parquet(out), batch)


def test_join_state_is_dropped(spark, feed, new_path):
    _, add, events = feed
    out, state = new_path(), new_path()

    def pairs():
        a = stream.with_lateness(events(), "ts", "10 minutes").select("user_id", F.col("event_id").alias("x"), F.col("ts").alias("a_ts"))
        b = stream.with_lateness(events(), "ts", "10 minutes").select("user_id", F.col("event_id").alias("y"), F.col("ts").alias("b_ts"))
        return stream.stream_interval_join(a, b, "user_id", "a_ts", "b_ts", 1800).select("x", "y")

    add(*[(i, i % 3, f"0{i % 4}:{i % 60:02d}", 1) for i in range(100)])
    runs.run_to_files(pairs(), out, state)
    add((200, 1, "20:00", 1))
    query = runs.run_to_files(pairs(), out, state)
    # Of 100 old rows a side (b in two slots) only the new one's are left.
    left = runs.state_report(query).groupBy("batch").agg(F.sum("rows").alias("n")).orderBy(F.desc("batch"))
    assert left.first()["n"] <= 3
