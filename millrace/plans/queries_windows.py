"""Window queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.dates import calendar_fill
from millrace.operators import windows as win
from millrace.operators.aggregates import money
from millrace.operators.skew import HOT_ROWS
from millrace.operators.windows import Split, SplitWindow
from millrace.plans.registry import query
from millrace.plans.shapes import HOT

_W = "PARTITION BY cust_id ORDER BY order_date, order_id"
_ROWS = "ROWS BETWEEN UNBOUNDED PRECEDING AND"


def _orders(t):
    return t.ord.select("cust_id", "order_id", "order_date", "amount")


def _by_date(t, hot_rows=HOT_ROWS):
    return SplitWindow(_orders(t), ["cust_id"], ["order_date", "order_id"], Split(hot_rows=hot_rows))


_RANKS = """SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_size, p_partkey) AS rn,
    rank() OVER (PARTITION BY p_brand ORDER BY p_size) AS rnk, dense_rank() OVER (PARTITION BY p_brand ORDER BY p_size) AS dense
    FROM part"""


def _rank_all(t, hot_rows):
    part = t["part"].select("p_brand", "p_partkey", "p_size")
    split = Split(hot_rows=hot_rows)
    ranked = win.with_peers(part, ["p_brand"], ["p_size"], split, "rnk", "dense")
    return SplitWindow(ranked, ["p_brand"], ["p_size", "p_partkey"], split).number("rn").frame().drop("p_size")


@query("w01_rank_all", _RANKS)
def _(t):
    return _rank_all(t, HOT_ROWS)


@query("w01_rank_all_split", _RANKS)
def _(t):
    return _rank_all(t, HOT)


_LAG_LEAD = f"""SELECT cust_id, order_id, lag(amount) OVER ({_W}) AS previous, lead(amount) OVER ({_W}) AS following,
    lag(amount, 2, 0) OVER ({_W}) AS two_back FROM #ord"""


def _lag_lead(t, hot_rows):
    w = _by_date(t, hot_rows).neighbour(F.col("amount"), "previous", -1).neighbour(F.col("amount"), "following", 1)
    return w.neighbour(F.col("amount"), "two_back", -2, F.lit(0.0)).frame().drop("order_date", "amount")


@query("w02_lag_lead", _LAG_LEAD)
def _(t):
    return _lag_lead(t, HOT_ROWS)


@query("w02_lag_lead_split", _LAG_LEAD)
def _(t):
    return _lag_lead(t, HOT)


@query("w03_lag_ignore_nulls", f"""SELECT cust_id, order_id, last_value(CASE WHEN status <> 'Pending' THEN amount END IGNORE NULLS)
    OVER ({_W} {_ROWS} 1 PRECEDING) AS known FROM #ord""")
def _(t):
    present = t.ord.withColumn("settled", F.when(F.col("status") != "Pending", F.col("amount")))
    w = SplitWindow(present, ["cust_id"], ["order_date", "order_id"], Split())
    return w.last_known(F.col("settled"), "known").frame().select("cust_id", "order_id", "known")


_RUNNING = f"""SELECT cust_id, order_id, sum(money) OVER ({_W} {_ROWS} CURRENT ROW)::DOUBLE AS running,
    row_number() OVER ({_W}) AS nth FROM #ord"""


def _running(t, hot_rows):
    w = _by_date(t, hot_rows).running(money("amount"), "running").number("nth")
    return w.frame().select("cust_id", "order_id", "running", "nth")


@query("w04_running_total", _RUNNING)
def _(t):
    return _running(t, HOT_ROWS)


@query("w04_running_total_split", _RUNNING)
def _(t):
    return _running(t, HOT)


@query("w05_running_total_range", """SELECT p_brand, p_partkey, sum(p_retailprice::DECIMAL(18,2)) OVER
    (PARTITION BY p_brand ORDER BY p_size)::DOUBLE AS running FROM part""")
def _(t):
    part = t["part"].select("p_brand", "p_partkey", "p_size", "p_retailprice")
    totals = win.with_peers(
        part, ["p_brand"], ["p_size"], Split(hot_rows=HOT), total="running", value=money("p_retailprice")
    )
    return totals.select("p_brand", "p_partkey", "running")


@query("w06_prior_total", f"""SELECT cust_id, order_id, sum(money) OVER ({_W} {_ROWS} 1 PRECEDING)::DOUBLE AS prior
    FROM #ord""")
def _(t):
    return _by_date(t).running(money("amount"), "prior", inclusive=False).frame().select("cust_id", "order_id", "prior")


@query("w07_rolling_avg", """SELECT day::VARCHAR AS day, avg(orders) OVER (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
    AS rolling_7 FROM (SELECT order_date AS day, count(*) AS orders FROM #ord GROUP BY day)""")
def _(t):
    daily = t.ord.groupBy(F.col("order_date").alias("day")).agg(F.count("*").alias("orders"))
    return win.rolling_mean(daily, "day", "orders", 7, "rolling_7").select("day", "rolling_7")


@query("w08_rolling_on_spine", """WITH months AS (SELECT CAST(unnest(generate_series(
    (SELECT date_trunc('month', min(order_date)) FROM #ord),
    (SELECT date_trunc('month', max(order_date)) FROM #ord), INTERVAL 1 MONTH)) AS DATE) AS month),
    totals AS (SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, sum(money) AS total FROM #ord
    GROUP BY 1)
    SELECT month::VARCHAR AS month, coalesce(total, 0)::DOUBLE AS total,
    sum(coalesce(total, 0)) OVER (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)::DOUBLE AS rolling_3m
    FROM months LEFT JOIN totals USING (month)""")
def _(t):
    monthly = t.ord.groupBy(F.trunc("order_date", "month").alias("month")).agg(F.sum(money("amount")).alias("total"))
    full = calendar_fill(monthly, "month", "1 MONTH", ["total"])
    return win.rolling_sum(full, "month", "total", 3, "rolling_3m")


@query("w09_range_sum", """SELECT cust_id, order_id, sum(money) OVER (PARTITION BY cust_id ORDER BY order_date
    RANGE BETWEEN INTERVAL 30 DAYS PRECEDING AND CURRENT ROW)::DOUBLE AS last_30 FROM #ord""")
def _(t):
    recent = win.recent_total(_orders(t), ["cust_id"], "order_date", money("amount"), 30, "last_30")
    return recent.select("cust_id", "order_id", "last_30")


@query("w09_range_sum_nulls", """SELECT cust_id, order_id, sum(money) OVER (PARTITION BY cust_id ORDER BY order_date
    RANGE BETWEEN INTERVAL 30 DAYS PRECEDING AND CURRENT ROW)::DOUBLE AS last_30 FROM (SELECT order_id, money,
    CASE WHEN status <> 'Pending' THEN cust_id END AS cust_id, CASE WHEN amount <= 300000 THEN order_date END AS order_date FROM #ord)""")
def _(t):
    # Pending orders have no customer yet, and large ones no date.
    open_ = t.ord.withColumn("cust_id", F.when(F.col("status") != "Pending", F.col("cust_id")))
    open_ = open_.withColumn("order_date", F.when(F.col("amount") <= 300000, F.col("order_date")))
    recent = win.recent_total(open_, ["cust_id"], "order_date", money("amount"), 30, "last_30")
    return recent.select("cust_id", "order_id", "last_30")


@query("w10_gap_days", f"SELECT cust_id, order_id, date_diff('day', lag(order_date) OVER ({_W}), order_date) AS gap FROM #ord")
def _(t):
    placed = _by_date(t).neighbour(F.col("order_date"), "before", -1).frame()
    return placed.select("cust_id", "order_id", F.datediff("order_date", "before").alias("gap"))


def _totals(t):
    return t.ord.groupBy("cust_id").agg(
        F.floor(F.sum(money("amount")) / 10000).cast("bigint").alias("total"), F.max("order_date").alias("last_order")
    )


_TOTALS = """(SELECT cust_id, CAST(floor(sum(money)::DOUBLE / 10000) AS BIGINT) AS total, max(order_date) AS last_order
    FROM #ord GROUP BY cust_id)"""


@query("w11_global_running", f"""SELECT cust_id, total, last_order::VARCHAR AS last_order, sum(total) OVER
    (ORDER BY total DESC, cust_id {_ROWS} CURRENT ROW)::BIGINT AS running, rank() OVER (ORDER BY total DESC) AS rank
    FROM {_TOTALS}""")
def _(t):
    return win.global_running(_totals(t), "total", "cust_id").drop("dense_rank")


@query("w12_global_dense_rank", f"SELECT cust_id, total, dense_rank() OVER (ORDER BY total DESC) AS dense_rank FROM {_TOTALS}")
def _(t):
    return win.global_ranks(_totals(t).drop("last_order"), "total").drop("rank")


@query("w13_period_change", """WITH m AS (SELECT CAST(date_trunc('month', order_date) AS DATE) AS month,
    sum(money)::DOUBLE AS total FROM #ord GROUP BY 1)
    SELECT month::VARCHAR AS month, total, lag(total) OVER (ORDER BY month) AS previous,
    (total - lag(total) OVER (ORDER BY month)) * 100 / lag(total) OVER (ORDER BY month) AS change_pct FROM m""")
def _(t):
    monthly = t.ord.groupBy(F.trunc("order_date", "month").alias("month")).agg(
        F.sum(money("amount")).cast("double").alias("total")
    )
    return win.period_change(monthly, "month", "total")


@query("w14_group_count", "SELECT order_id, cust_id, count(*) OVER (PARTITION BY cust_id) AS group_rows FROM #ord")
def _(t):
    return win.group_count(t.ord.select("order_id", "cust_id"), ["cust_id"])


@query("w15_named_window", f"""SELECT cust_id, order_id, row_number() OVER w AS nth, lag(order_date) OVER w::VARCHAR AS before,
    (sum(money) OVER (w {_ROWS} CURRENT ROW))::DOUBLE AS running FROM #ord WINDOW w AS ({_W})""")
def _(t):
    w = _by_date(t).number("nth").neighbour(F.col("order_date"), "before", -1)
    return w.running(money("amount"), "running").frame().drop("order_date", "amount")


_SESSIONS = """SELECT event_id, user_id, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS session_no FROM (SELECT *, CASE WHEN ts - lag(ts) OVER
    (PARTITION BY user_id ORDER BY ts, event_id) > INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS fresh FROM events)"""


def _sessions(t, hot_rows):
    events = t["events"].select("event_id", "user_id", "ts")
    return win.sessionize(events, "user_id", "ts", "30 MINUTES", Split(hot_rows=hot_rows), "event_id").drop("ts")


@query("w16_sessionize", _SESSIONS)
def _(t):
    return _sessions(t, HOT_ROWS)


@query("w16_sessionize_split", _SESSIONS)
def _(t):
    return _sessions(t, HOT)


