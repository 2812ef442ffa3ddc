"""Streaming queries: the stream runs over all event files, stops, and its output is read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.plans.queries_joins import VIEW_TO_PURCHASE
from millrace.plans.registry import query
from millrace.session import shared_path
from millrace.sources.versions import VersionedTable
from millrace.streaming import events as stream
from millrace.streaming import runs

DELAY = "10 minutes"


def _events(t):
    # A pattern, so that the table may be one file or a folder of files.
    path = f"{t.folder}/events*.parquet"
    return stream.read_events(t.spark, path, t["events"].schema, "ts")


def _late_ok(t):
    return stream.with_lateness(_events(t), "ts", DELAY)


def _aggs():
    return {"events": F.count("*"), "total": F.sum(F.col("value").cast("decimal(18,2)"))}


def _run(t, df):
    out, state = shared_path(t.spark, "out"), shared_path(t.spark, "state")
    runs.run_to_files(df, out, state)
    return t.spark.read.parquet(out)


# A window is final once the watermark has passed its end.
_CLOSED = "(SELECT max(ts) - INTERVAL 10 MINUTE FROM events)"


@query("t01_lateness", "SELECT event_id, ts::VARCHAR AS ts FROM events")
def _(t):
    return _run(t, _late_ok(t).select("event_id", "ts"))


@query("t02_tumbling", f"""SELECT start::VARCHAR AS start, (start + INTERVAL 1 HOUR)::VARCHAR AS "end", count(*) AS events,
    sum(value::DECIMAL(18,2))::DOUBLE AS total FROM (SELECT date_trunc('hour', ts) AS start, value FROM events)
    GROUP BY start HAVING start + INTERVAL 1 HOUR <= {_CLOSED}""")
def _(t):
    return _run(t, stream.tumbling(_late_ok(t), "ts", "1 hour", _aggs()))


@query("t03_sliding", f"""SELECT start::VARCHAR AS start, (start + INTERVAL 1 HOUR)::VARCHAR AS "end", event_type, count(*) AS events
    FROM (SELECT unnest([time_bucket(INTERVAL 30 MINUTE, ts), time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE]) AS start,
    event_type FROM events) GROUP BY start, event_type HAVING start + INTERVAL 1 HOUR <= {_CLOSED}""")
def _(t):
    windows = stream.sliding(_late_ok(t), "ts", "1 hour", "30 minutes", {"events": F.count("*")}, ["event_type"])
    return _run(t, windows)


@query("t04_sessions", f"""SELECT user_id, min(ts)::VARCHAR AS start, (max(ts) + INTERVAL 30 MINUTE)::VARCHAR AS "end", count(*) AS events
    FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s
    FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END
    AS fresh FROM events)) GROUP BY user_id, s HAVING max(ts) + INTERVAL 30 MINUTE <= {_CLOSED}""")
def _(t):
    return _run(t, stream.sessions(_late_ok(t), "user_id", "ts", "30 minutes", {"events": F.count("*")}))


@query("t05_dedup", "SELECT event_id, user_id FROM events")
def _(t):
    twice = _events(t).unionByName(_events(t).where(F.col("event_type") == "purchase"))
    deduped = stream.stream_dedup(stream.with_lateness(twice, "ts", DELAY), ["event_id"])
    return _run(t, deduped.select("event_id", "user_id"))


_PER_USER = "SELECT user_id, count(*) AS events, sum(value::DECIMAL(18,2))::DOUBLE AS total FROM events GROUP BY user_id"


def _per_user(t):
    return _events(t).groupBy("user_id").agg(*[c.alias(n) for n, c in _aggs().items()])


@query("t06_complete", _PER_USER)
def _(t):
    out, state = shared_path(t.spark, "out"), shared_path(t.spark, "state")
    runs.run_mode(_per_user(t), "complete", out, state)
    return runs.latest_complete(t.spark, out)


@query("t06_complete_replay", _PER_USER)
def _(t):
    # A first run over large values only, then a replay of everything with a new checkpoint into the same folder.
    out = shared_path(t.spark, "out")
    aggs = [c.alias(n) for n, c in _aggs().items()]
    runs.run_mode(_events(t).where("value > 30").groupBy("user_id").agg(*aggs), "complete", out, shared_path(t.spark, "state"))
    runs.run_mode(_per_user(t), "complete", out, shared_path(t.spark, "state"))
    return runs.latest_complete(t.spark, out)


@query("t06_update", _PER_USER)
def _(t):
    out, state = shared_path(t.spark, "out"), shared_path(t.spark, "state")
    runs.run_mode(_per_user(t), "update", out, state)
    return runs.latest_updates(t.spark, out, "user_id")


@query("t07_interval_join", VIEW_TO_PURCHASE)
def _(t):
    late_ok = _late_ok(t)
    a = late_ok.where("event_type = 'view'").select("user_id", F.col("event_id").alias("view_id"), F.col("ts").alias("a_ts"))
    late_ok = _late_ok(t)
    b = late_ok.where("event_type = 'purchase'").select(
        "user_id", F.col("event_id").alias("purchase_id"), F.col("ts").alias("b_ts")
    )
    pairs = stream.stream_interval_join(a, b, "user_id", "a_ts", "b_ts", 3600)
    return _run(t, pairs.select("view_id", "purchase_id", "user_id"))


@query("t08_enrich", "SELECT event_id, city FROM events JOIN #cust ON cust_id = user_id")
def _(t):
    who = t.cust.select(F.col("cust_id").alias("user_id"), "city")
    return _run(t, stream.enrich(_events(t).select("event_id", "user_id"), who, "user_id").select("event_id", "city"))


@query("t09_restart", "SELECT event_id, value FROM events")
def _(t):
    out, state = shared_path(t.spark, "out"), shared_path(t.spark, "state")
    for _ in range(2):  # the second run finds nothing new
        runs.run_to_files(_events(t).select("event_id", "value"), out, state)
    return t.spark.read.parquet(out)


@query("t10_upsert", """SELECT cust_id, record_id, city FROM #upd
    QUALIFY row_number() OVER (PARTITION BY cust_id ORDER BY updated_at DESC, record_id DESC) = 1""")
def _(t):
    log = _events(t).select(
        F.col("user_id").alias("cust_id"), F.col("event_id").alias("record_id"), F.col("event_type").alias("city"),
        F.col("ts").alias("updated_at"),
    )
    target, state = shared_path(t.spark, "target"), shared_path(t.spark, "state")
    runs.stream_upsert(log, target, state, "cust_id", "updated_at", "record_id")
    current = runs.upserted(t.spark, target, "cust_id", "updated_at", "record_id")
    return current.select("cust_id", "record_id", "city")


@query("t10_upsert_deletes", """SELECT cust_id, record_id, city FROM (SELECT * FROM #upd
    QUALIFY row_number() OVER (PARTITION BY cust_id ORDER BY updated_at DESC, record_id DESC) = 1) WHERE operation <> 'DELETE'""")
def _(t):
    log = _events(t).select(
        F.col("user_id").alias("cust_id"), F.col("event_id").alias("record_id"), F.col("event_type").alias("city"),
        F.col("ts").alias("updated_at"), F.when(F.col("event_type") == "error", "DELETE").otherwise("UPDATE").alias("operation"),
    )
    first, folded = shared_path(t.spark, "target"), shared_path(t.spark, "target")
    early = F.col("updated_at") < F.lit("2024-01-15").cast("timestamp_ntz")
    by = ("cust_id", "updated_at", "record_id")
    runs.stream_upsert(log.where(early), first, shared_path(t.spark, "state"), *by)
    runs.fold_upserts(t.spark, first, folded, *by)
    runs.stream_upsert(log.where(~early), folded, shared_path(t.spark, "state"), *by)
    return runs.upserted(t.spark, folded, *by, op="operation").select("cust_id", "record_id", "city")


@query("t10_upsert_versions", """SELECT cust_id, record_id, city FROM (SELECT * FROM #upd
    QUALIFY row_number() OVER (PARTITION BY cust_id ORDER BY updated_at DESC, record_id DESC) = 1) WHERE operation <> 'DELETE'""")
def _(t):
    log = _events(t).select(
        F.col("user_id").alias("cust_id"), F.col("event_id").alias("record_id"), F.col("event_type").alias("city"),
        F.col("ts").alias("updated_at"), F.when(F.col("event_type") == "error", "DELETE").otherwise("UPDATE").alias("operation"),
    )
    path = shared_path(t.spark, "target")
    VersionedTable.create(t.spark.createDataFrame([], log.schema), path, ["cust_id"], 8)
    early = F.col("updated_at") < F.lit("2024-01-15").cast("timestamp_ntz")
    for half in (~early, early):  # the older half arrives last
        runs.stream_into_versions(log.where(half), path, shared_path(t.spark, "state"), "cust_id", "updated_at", "record_id")
    current = VersionedTable(t.spark, path).read()
    return current.where("operation <> 'DELETE'").select("cust_id", "record_id", "city")


@query("t11_replay", "SELECT event_id, value FROM events")
def _(t):
    # A backfill is the same stream under a new checkpoint, into a new folder.
    _run(t, _events(t).where("event_type = 'view'").select("event_id", "value"))
    return _run(t, _events(t).select("event_id", "value"))


@query("t13_running_state", "SELECT user_id, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY user_id")
def _(t):
    out, state = shared_path(t.spark, "out"), shared_path(t.spark, "state")
    totals = stream.running_state(_events(t), "user_id", "value", "event_id")
    with stream.rocksdb_state(t.spark):
        runs.run_mode(totals, "update", out, state)
    combined = stream.combine_shards(t.spark.read.parquet(out), "user_id")
    return combined.select("user_id", "n", F.round("total", 4).alias("total"))


@query("t12_run_available", "SELECT event_type, count(*) AS events FROM events GROUP BY event_type")
def _(t):
    return _run(t, _events(t).select("event_type")).groupBy("event_type").agg(F.count("*").alias("events"))


@query("t14_state_report", "SELECT count(DISTINCT user_id) AS rows FROM events")
def _(t):
    out, state = shared_path(t.spark, "out"), shared_path(t.spark, "state")
    done = runs.run_mode(_per_user(t), "update", out, state)
    return runs.state_report(done).agg(F.max("rows").alias("rows"))
