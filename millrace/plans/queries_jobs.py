"""Composite jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.aggregates import money
from millrace.operators.sketches import fold_states
from millrace.operators.windows import Split
from millrace.plans import jobs
from millrace.plans.registry import query
from millrace.session import shared_path
from millrace.sources.files import write_parquet
from millrace.sources.history import KeptHistory
from millrace.sources.versions import VersionedTable

_DAILY = "SELECT CAST(date_trunc('day', ts) AS DATE)::VARCHAR AS period, count(DISTINCT user_id) AS users, TRUE AS close FROM events GROUP BY 1"


def _active(t, grain):
    counted = jobs.active_users(t["events"], "user_id", "ts", grain, 0.02)
    off = F.abs(F.col("users_approx") - F.col("users")) / F.col("users")
    return counted.select("period", "users", (off <= 0.08).alias("close"))


@query("z01_daily_users", _DAILY)
def _(t):
    return _active(t, "day")


@query("z01_monthly_users", _DAILY.replace("'day'", "'month'"))
def _(t):
    return _active(t, "month")


def _kept_states(t):
    # A first load, and then the last ten days and stragglers of the days before, delivered twice.
    late = (F.col("ts") >= F.lit("2024-01-20").cast("timestamp_ntz")) | (F.col("value") > 30)
    first, batch = (jobs.daily_states(t["events"].where(c), "user_id", "ts", "value") for c in (~late, late))
    table = VersionedTable.create(first, shared_path(t.spark, "states"), ["day"])
    for _ in range(2):
        fold_states(table, batch, ["day"], jobs.STATE_KINDS, ("events", 1))
    return table.read()


@query("z01_mau_from_states", """SELECT CAST(date_trunc('month', ts) AS DATE)::VARCHAR AS month, count(*) AS events, TRUE AS users_close
    FROM events GROUP BY 1""")
def _(t):
    # Within four standard errors of the exact number of users.
    monthly = jobs.monthly_from_states(_kept_states(t), 0.9)
    users = F.countDistinct("user_id").alias("n")
    exact = t["events"].groupBy(F.date_trunc("month", "ts").cast("date").alias("month")).agg(users)
    off = F.abs(F.col("users") - F.col("n")) / F.col("n")
    return monthly.join(exact, "month").select("month", "events", (off <= 4 * 1.04 / 2**7).alias("users_close"))


@query("z01_percentile_from_states", """SELECT CAST(date_trunc('month', ts) AS DATE)::VARCHAR AS month, TRUE AS rank_close FROM events GROUP BY 1""")
def _(t):
    monthly = jobs.monthly_from_states(_kept_states(t), 0.9).select("month", "quantile")
    values = t["events"].select(F.date_trunc("month", "ts").cast("date").alias("month"), "value").join(F.broadcast(monthly), "month")
    below, upto = F.avg((F.col("value") < F.col("quantile")).cast("double")), F.avg((F.col("value") <= F.col("quantile")).cast("double"))
    ranks = values.groupBy("month").agg(below.alias("below"), upto.alias("upto"))
    return ranks.select("month", ((F.col("below") <= 0.9 + 0.01) & (F.col("upto") >= 0.9 - 0.01)).alias("rank_close"))


@query("z02_top_events", """SELECT hour::VARCHAR AS hour, event_type, events, position FROM (SELECT *, row_number() OVER
    (PARTITION BY hour ORDER BY events DESC, event_type) AS position FROM (SELECT date_trunc('hour', ts) AS hour, event_type,
    count(*) AS events FROM events GROUP BY ALL)) WHERE position <= 3""")
def _(t):
    return jobs.top_events(t["events"], "ts", "event_type", 3)


_SESSION = "PARTITION BY user_id ORDER BY ts, event_id"
_STEP = "PARTITION BY user_id, s ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"


@query("z03_funnel", f"""WITH f AS (SELECT *, CASE WHEN ts - lag(ts) OVER ({_SESSION}) > INTERVAL 12 HOUR THEN 1 ELSE 0 END AS fresh
    FROM events), n AS (SELECT *, sum(fresh) OVER ({_SESSION} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s FROM f),
    a AS (SELECT *, CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS h0 FROM n),
    b AS (SELECT *, CASE WHEN event_type = 'click' AND sum(h0) OVER ({_STEP}) > 0 THEN 1 ELSE 0 END AS h1 FROM a),
    c AS (SELECT *, CASE WHEN event_type = 'purchase' AND sum(h1) OVER ({_STEP}) > 0 THEN 1 ELSE 0 END AS h2 FROM b),
    d AS (SELECT user_id, s, max(h0) AS h0, max(h1) AS h1, max(h2) AS h2 FROM c GROUP BY user_id, s)
    SELECT 'view' AS step, sum(h0)::BIGINT AS sessions FROM d UNION ALL SELECT 'click', sum(h1)::BIGINT FROM d
    UNION ALL SELECT 'purchase', sum(h2)::BIGINT FROM d""")
def _(t):
    steps = ["view", "click", "purchase"]
    return jobs.funnel(t["events"], "user_id", "ts", "event_type", "event_id", steps, "12 HOURS", Split())


@query("z04_land", """SELECT 'landed' AS kind, CAST(ts AS DATE)::VARCHAR AS day, count(*) AS rows, sum(value::DECIMAL(18,2))::DOUBLE AS total
    FROM events WHERE event_type <> 'error' GROUP BY day
    UNION ALL SELECT 'rejected', CAST(ts AS DATE)::VARCHAR, count(*), sum(value::DECIMAL(18,2))::DOUBLE FROM
    (SELECT * FROM events UNION ALL SELECT * FROM events WHERE value > 30) WHERE event_type = 'error' GROUP BY 2""")
def _(t):
    # Errors come without a user, and large values are delivered twice.
    known = F.when(F.col("event_type") != "error", F.col("user_id"))
    events = t["events"].drop("props").withColumn("user_id", known)
    delivered = events.unionByName(events.where(F.col("value") > 30))
    path = shared_path(t.spark, "landing")
    rules = {"user": F.col("user_id").isNotNull(), "ts": F.col("ts").isNotNull()}
    bad = jobs.land(delivered, path, "event_id", ["ts"], "ts", rules)
    both = t.spark.read.parquet(path).select(F.lit("landed").alias("kind"), "day", "value").unionByName(
        bad.select(F.lit("rejected").alias("kind"), F.to_date("ts").alias("day"), "value")
    )
    return both.groupBy("kind", "day").agg(F.count("*").alias("rows"), F.sum(money("value")).alias("total"))


@query("z04_land_new", """SELECT CAST(ts AS DATE)::VARCHAR AS day, CASE WHEN value > 30 THEN 1 ELSE 2 END AS batch, count(*) AS rows,
    sum(value::DECIMAL(18,2))::DOUBLE AS total FROM events WHERE event_type <> 'error' GROUP BY ALL""")
def _(t):
    # The second delivery repeats the first one, the third all of both.
    events = t["events"].drop("props").withColumn("user_id", F.when(F.col("event_type") != "error", F.col("user_id")))
    rules = {"user": F.col("user_id").isNotNull(), "ts": F.col("ts").isNotNull()}
    path = shared_path(t.spark, "landing")
    for batch, delivered in enumerate([events.where(F.col("value") > 30), events, events], 1):
        jobs.land_new(delivered, path, "event_id", ["ts"], "ts", rules, batch)
    landed = VersionedTable(t.spark, path).read()
    return landed.groupBy("day", "batch").agg(F.count("*").alias("rows"), F.sum(money("value")).alias("total"))


@query("z05_daily_summary", """SELECT CAST(ts AS DATE)::VARCHAR AS day, event_type, count(*) AS events,
    sum(value::DECIMAL(18,2))::DOUBLE AS total FROM events GROUP BY ALL""")
def _(t):
    path = shared_path(t.spark, "summary")
    # The batch brings ten new days, and stragglers for the days before.
    late = (F.col("ts") >= F.lit("2024-01-20").cast("timestamp_ntz")) | (F.col("value") > 30)
    first = jobs.daily_totals(t["events"].where(~late), "ts", "event_type", "value")
    write_parquet(first, path, ["day"])
    batch = jobs.daily_totals(t["events"].where(late), "ts", "event_type", "value")
    jobs.add_to_summary(path, batch, ["day", "event_type"], ["events", "total"], "day")
    return t.spark.read.parquet(path).select("day", "event_type", "events", "total")


@query("z05_daily_summary_undated", """SELECT CASE WHEN event_type <> 'error' THEN CAST(ts AS DATE) END::VARCHAR AS day, event_type,
    count(*) AS events, sum(value::DECIMAL(18,2))::DOUBLE AS total FROM events GROUP BY ALL""")
def _(t):
    path = shared_path(t.spark, "summary")
    # Errors come without a time, in the first load as well as in the batch.
    late = (F.col("ts") >= F.lit("2024-01-20").cast("timestamp_ntz")) | (F.col("value") > 30)
    known = F.when(F.col("event_type") != "error", F.col("ts"))
    first = jobs.daily_totals(t["events"].where(~late).withColumn("ts", known), "ts", "event_type", "value")
    write_parquet(first, path, ["day"])
    batch = jobs.daily_totals(t["events"].where(late).withColumn("ts", known), "ts", "event_type", "value")
    jobs.add_to_summary(path, batch, ["day", "event_type"], ["events", "total"], "day")
    return t.spark.read.parquet(path).select("day", "event_type", "events", "total")


@query("z05_daily_summary_versions", """SELECT CAST(ts AS DATE)::VARCHAR AS day, event_type, count(*) AS events,
    sum(value::DECIMAL(18,2))::DOUBLE AS total FROM events GROUP BY ALL""")
def _(t):
    late = (F.col("ts") >= F.lit("2024-01-20").cast("timestamp_ntz")) | (F.col("value") > 30)
    first = jobs.daily_totals(t["events"].where(~late), "ts", "event_type", "value")
    table = VersionedTable.create(first, shared_path(t.spark, "summary"), ["day"])
    batch = jobs.daily_totals(t["events"].where(late), "ts", "event_type", "value")
    for _ in range(2):  # the second delivery changes nothing
        jobs.fold_into_versions(table, batch, ["day", "event_type"], ["events", "total"], ("events", 1))
    return table.read().select("day", "event_type", "events", "total")


@query("z06_features", """WITH daily AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS events,
    sum(value::DECIMAL(18,2)) AS value FROM events GROUP BY ALL),
    seen AS (SELECT *, unnest(range(1, 8)) AS ahead FROM daily)
    SELECT user_id, CAST(day + ahead::INTEGER AS DATE)::VARCHAR AS feature_day,
    coalesce(max(CASE WHEN ahead = 1 THEN events END), 0) AS events_1d,
    coalesce(max(CASE WHEN ahead = 1 THEN value END), 0)::DOUBLE AS value_1d,
    sum(events)::BIGINT AS events_7d, sum(value)::DOUBLE AS value_7d FROM seen GROUP BY 1, 2""")
def _(t):
    return jobs.features(t["events"], "user_id", "ts", money("value"))


@query("z07_monthly_report", """WITH months AS (SELECT CAST(m AS DATE) AS month FROM generate_series(
    (SELECT date_trunc('month', min(order_date))::TIMESTAMP FROM #ord),
    (SELECT date_trunc('month', max(order_date))::TIMESTAMP FROM #ord), INTERVAL 1 MONTH) s(m)),
    full_months AS (SELECT month, coalesce(sum(money), 0) AS total, count(order_id) AS orders FROM months LEFT JOIN
    #ord o ON CAST(date_trunc('month', order_date) AS DATE) = month GROUP BY month),
    lagged AS (SELECT *, lag(total) OVER (ORDER BY month) AS previous,
    sum(total) OVER (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS rolling_3m FROM full_months)
    SELECT month::VARCHAR AS month, orders, total::DOUBLE AS total, previous::DOUBLE AS previous, rolling_3m::DOUBLE AS rolling_3m,
    round(CASE WHEN previous <> 0 THEN (total::DOUBLE - previous::DOUBLE) * 100 / previous::DOUBLE END, 4) AS change_pct FROM lagged""")
def _(t):
    report = jobs.monthly_report(t.ord, "order_date", money("amount"))
    change = F.try_divide((F.col("total") - F.col("previous")).cast("double") * 100, F.col("previous").cast("double"))
    return report.withColumn("change_pct", F.round(change, 4))


@query("z08_change_history", """WITH starts AS (SELECT * FROM (SELECT *, lag(struct_pack(city, operation)) OVER
    (PARTITION BY cust_id ORDER BY updated_at, record_id) AS p FROM #upd) WHERE p IS NULL OR p <> struct_pack(city, operation)),
    versions AS (SELECT cust_id, city, updated_at AS valid_from, operation,
    lead(updated_at) OVER (PARTITION BY cust_id ORDER BY updated_at, record_id) AS valid_to FROM starts)
    SELECT 'history' AS kind, cust_id, city, valid_from::VARCHAR AS valid_from, valid_to::VARCHAR AS valid_to
    FROM versions WHERE operation <> 'DELETE'
    UNION ALL SELECT 'current', cust_id, city, updated_at::VARCHAR, NULL FROM (SELECT * FROM #upd QUALIFY row_number() OVER
    (PARTITION BY cust_id ORDER BY updated_at DESC, record_id DESC) = 1) WHERE operation <> 'DELETE'""")
def _(t):
    history, current = jobs.change_history(
        [t.upd, t.upd.where("city = 'purchase'")], "cust_id", "updated_at", "record_id", "operation", ["city"],
        Split(),
    )
    rows = history.select(F.lit("history").alias("kind"), "cust_id", "city", "valid_from", "valid_to")
    latest = current.select(F.lit("current").alias("kind"), "cust_id", "city", F.col("updated_at").alias("valid_from"))
    return rows.unionByName(latest, allowMissingColumns=True)


@query("z08_change_history_daily", """WITH starts AS (SELECT * FROM (SELECT *, lag(struct_pack(city, operation)) OVER
    (PARTITION BY cust_id ORDER BY updated_at, record_id) AS p FROM #upd) WHERE p IS NULL OR p <> struct_pack(city, operation)),
    versions AS (SELECT cust_id, city, updated_at AS valid_from, operation,
    lead(updated_at) OVER (PARTITION BY cust_id ORDER BY updated_at, record_id) AS valid_to FROM starts)
    SELECT cust_id, city, valid_from::VARCHAR AS valid_from, valid_to::VARCHAR AS valid_to, valid_to IS NULL AS is_current
    FROM versions WHERE operation <> 'DELETE'""")
def _(t):
    # Three deliveries of a change log, the first repeated within the second; a DELETE ends a version.
    kept = KeptHistory(shared_path(t.spark, "history"), "cust_id", "updated_at", "record_id", ["city", "operation"])
    kept.create(t.upd, 16)
    half = F.col("record_id") % 2 == 0
    for number, delivery in enumerate([t.upd.where(half), t.upd.where(half | (F.col("city") == "view")), t.upd.where(~half)]):
        kept.add(delivery, ("changes", number))
    return kept.read(t.spark).where("operation <> 'DELETE'").drop("operation", "record_id")


@query("z09_reconcile_revenue", """WITH v AS (SELECT event_id, ts, CASE WHEN event_type <> 'error' THEN value::DECIMAL(18,2) END AS m,
    CASE WHEN event_type = 'purchase' THEN 2 ELSE 1 END AS copies FROM events),
    sides AS (SELECT CAST(ts AS DATE) AS day, m, copies, TRUE AS utc FROM v
    UNION ALL SELECT CAST(ts + INTERVAL 330 MINUTE AS DATE), m, copies, FALSE FROM v)
    SELECT day::VARCHAR AS day, sum(m * copies) FILTER (utc)::DOUBLE AS naive_total, sum(m) FILTER (utc)::DOUBLE AS deduped_total,
    sum(m) FILTER (NOT utc)::DOUBLE AS zone_total, coalesce(sum(copies - 1) FILTER (utc), 0)::BIGINT AS repeated_rows,
    count(*) FILTER (utc AND m IS NULL) AS missing_amounts FROM sides GROUP BY day""")
def _(t):
    # Errors carry no amount, and purchases were delivered twice.
    events = t["events"].withColumn("value", F.when(F.col("event_type") != "error", F.col("value")))
    raw = events.unionByName(events.where(F.col("event_type") == "purchase")).select("event_id", "ts", "value")
    return jobs.reconcile_revenue(raw, "event_id", "ts", "value", "Asia/Kolkata")
