"""Join queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.dates import calendar_fill
from millrace.operators import joins, skew
from millrace.operators.aggregates import money
from millrace.plans.registry import query
from millrace.session import shared_path
from millrace.sources import tables


@query("j01_inner_join", "SELECT order_id, cust_id, cust_name, amount FROM #ord JOIN #cust USING (cust_id)")
def _(t):
    return joins.inner_join(t.ord, t.cust, "cust_id").select("order_id", "cust_id", "cust_name", "amount")


# Customers, and suppliers numbered beyond them, who never order.
_PEOPLE = "(SELECT cust_id, cust_name FROM #cust UNION ALL SELECT s_suppkey + 1000000000, s_name FROM supplier)"


def _people(t):
    others = t["supplier"].select((F.col("s_suppkey") + 1_000_000_000).alias("cust_id"), F.col("s_name").alias("cust_name"))
    return t.cust.select("cust_id", "cust_name").unionByName(others)


@query("j02_left_join", f"SELECT c.cust_id, cust_name, order_id, amount FROM {_PEOPLE} c LEFT JOIN #ord o ON c.cust_id = o.cust_id")
def _(t):
    return joins.left_join(_people(t), t.ord, "cust_id").select("cust_id", "cust_name", "order_id", "amount")


@query("j03_full_outer_merge", """WITH a AS (SELECT * FROM #upd WHERE updated_at < TIMESTAMP '2024-01-20'
    QUALIFY row_number() OVER (PARTITION BY cust_id ORDER BY updated_at DESC, record_id DESC) = 1),
    b AS (SELECT * FROM #upd WHERE updated_at >= TIMESTAMP '2024-01-10'
    QUALIFY row_number() OVER (PARTITION BY cust_id ORDER BY updated_at DESC, record_id DESC) = 1)
    SELECT cust_id, record_id, city, updated_at::VARCHAR AS updated_at FROM (SELECT * FROM a UNION ALL SELECT * FROM b)
    QUALIFY row_number() OVER (PARTITION BY cust_id ORDER BY updated_at DESC, record_id DESC) = 1""")
def _(t):
    log = t.upd.select("cust_id", "record_id", "city", "updated_at")
    at, version = F.col("updated_at"), ["updated_at", "record_id"]
    a = joins.latest_row(log.where(at < F.lit("2024-01-20").cast("timestamp_ntz")), "cust_id", version)
    late = log.where(at >= F.lit("2024-01-10").cast("timestamp_ntz"))
    return joins.newest(a, joins.latest_row(late, "cust_id", version), "cust_id", version)


@query("j04_semi_join", "SELECT cust_id, cust_name FROM #cust WHERE cust_id IN (SELECT cust_id FROM #ord WHERE amount > 450000)")
def _(t):
    big = t.ord.where(F.col("amount") > 450000)
    return joins.semi_join(t.cust, big, "cust_id").select("cust_id", "cust_name")


@query("j05_anti_join", """SELECT cust_id, cust_name FROM #cust
    WHERE cust_id NOT IN (SELECT cust_id FROM #ord WHERE amount > 450000)""")
def _(t):
    big = t.ord.where(F.col("amount") > 450000)
    return joins.anti_join(t.cust, big, "cust_id").select("cust_id", "cust_name")


@query("j06_sum_having", """SELECT cust_id, cust_name, sum(money)::DOUBLE AS total FROM #ord JOIN #cust USING (cust_id)
    GROUP BY cust_id, cust_name HAVING sum(money) > 2000000""")
def _(t):
    names = t.cust.select("cust_id", "cust_name")
    return joins.sum_having(t.ord, names, "cust_id", money("amount"), 2_000_000)


@query("j07_sum_or_zero", f"""SELECT c.cust_id, coalesce(sum(money), 0)::DOUBLE AS total FROM {_PEOPLE} c
    LEFT JOIN #ord o ON c.cust_id = o.cust_id GROUP BY c.cust_id""")
def _(t):
    return joins.sum_or_zero(_people(t).select("cust_id"), t.ord, "cust_id", money("amount"))


@query("j09_self_join_agg", """WITH heavy AS (SELECT cust_id, count(*) AS order_cnt, sum(money) AS total_amt FROM #ord
    GROUP BY cust_id) SELECT a.cust_id, a.total_amt::DOUBLE AS total_amt, b.order_cnt FROM heavy a
    JOIN heavy b ON a.cust_id = b.cust_id WHERE a.total_amt > b.order_cnt * 150000""")
def _(t):
    heavy = t.ord.groupBy("cust_id").agg(F.count("*").alias("order_cnt"), F.sum(money("amount")).alias("total_amt"))
    pairs = joins.inner_join(heavy.drop("order_cnt"), heavy.drop("total_amt"), "cust_id")
    return pairs.where(F.col("total_amt") > F.col("order_cnt") * 150000)


_BY_BRAND = "SELECT p_brand, count(*) AS rows, sum(l_quantity) AS quantity FROM {} JOIN part ON {} = p_partkey GROUP BY p_brand"


def _by_brand(joined):
    return joined.groupBy("p_brand").agg(F.count("*").alias("rows"), F.sum("l_quantity").alias("quantity"))


def _line(t):
    return t["lineitem"].select(F.col("l_partkey").alias("p_partkey"), "l_orderkey", "l_quantity")


def _part(t):
    return t["part"].select("p_partkey", "p_brand")


@query("j10_broadcast_join", _BY_BRAND.format("lineitem", "l_partkey"))
def _(t):
    return _by_brand(skew.broadcast_join(_line(t), _part(t), "p_partkey"))


@query("j11_hash_join", _BY_BRAND.format("lineitem", "l_partkey"))
def _(t):
    return _by_brand(joins.hash_join(_line(t), _part(t), "p_partkey"))


@query("j12_merge_join", _BY_BRAND.format("lineitem", "l_partkey"))
def _(t):
    return _by_brand(joins.merge_join(_line(t), _part(t), "p_partkey"))


@query("j13_bucketed_join", """SELECT o_orderpriority, count(*) AS rows, sum(l_quantity) AS quantity FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderpriority""")
def _(t):
    names = [shared_path(t.spark, n).rsplit("/", 1)[1].replace("-", "_") for n in ("lines", "heads")]
    lines = t["lineitem"].select(F.col("l_orderkey").alias("k"), "l_quantity")
    heads = t["orders"].select(F.col("o_orderkey").alias("k"), "o_orderpriority")
    for name, df in zip(names, (lines, heads)):
        tables.write_bucketed(df, name, 8, ["k"])
    joined = tables.bucketed_join(t.spark, *names, "k")
    return joined.groupBy("o_orderpriority").agg(F.count("*").alias("rows"), F.sum("l_quantity").alias("quantity"))


def _hot_sides(t):
    part = _part(t).withColumnRenamed("p_partkey", "k")
    return t.hot.select("k", "l_orderkey", "l_linenumber", "l_quantity"), part


@query("j14_salted_join", _BY_BRAND.format("#hot", "k"))
def _(t):
    large, small = _hot_sides(t)
    return _by_brand(skew.salted_join(large, small, "k", ["l_orderkey", "l_linenumber"]))


@query("j15_split_hot_join", _BY_BRAND.format("#hot", "k"))
def _(t):
    large, small = _hot_sides(t)
    return _by_brand(skew.split_hot_join(large, small, "k", ["l_orderkey", "l_linenumber"]))


_KEYS = """WITH l AS (SELECT order_id, nullif(cust_id, 7) AS k FROM #ord),
    r AS (SELECT cust_id, nullif(cust_id, 3) AS rk FROM #cust)
    SELECT order_id, cust_id FROM l JOIN r ON """


def _null_keys(t, mode, sentinel=None):
    left = t.ord.select("order_id", F.nullif("cust_id", F.lit(7)).alias("k"))
    right = t.cust.select("cust_id", F.nullif("cust_id", F.lit(3)).alias("rk"))
    return joins.join_nulls(left, right, "k", "rk", mode, sentinel).select("order_id", "cust_id")


@query("j16_null_keys_drop", _KEYS + "k = rk")
def _(t):
    return _null_keys(t, "drop")


@query("j16_null_keys_safe", _KEYS + "k IS NOT DISTINCT FROM rk")
def _(t):
    return _null_keys(t, "safe")


@query("j16_null_keys_sentinel", _KEYS + "coalesce(k, 9) = rk")
def _(t):
    return _null_keys(t, "sentinel", 9)


@query("j17_join_normalised", """SELECT id, cust_id FROM (SELECT order_id AS id, '  ' || upper('c' || cust_id) || ' ' AS code
    FROM #ord) l JOIN (SELECT cust_id, 'c' || cust_id AS name FROM #cust) r ON lower(trim(code)) = lower(trim(name))""")
def _(t):
    code = F.concat(F.lit("  "), F.upper(F.concat(F.lit("c"), F.col("cust_id"))), F.lit(" "))
    left = t.ord.select(F.col("order_id").alias("id"), code.alias("code"))
    right = t.cust.select("cust_id", F.concat(F.lit("c"), F.col("cust_id")).alias("name"))
    return joins.join_normalised(left, right, "code", "name").select("id", "cust_id")


@query("j18_year_over_year", """WITH days AS (SELECT CAST(unnest(generate_series((SELECT min(order_date) FROM #ord),
    (SELECT max(order_date) FROM #ord), INTERVAL 1 DAY)) AS DATE) AS day),
    daily AS (SELECT day, count(order_id) AS orders FROM days LEFT JOIN #ord ON day = order_date GROUP BY day)
    SELECT a.day::VARCHAR AS day, a.orders, b.orders AS last_year FROM daily a LEFT JOIN daily b
    ON strftime(a.day, '%m-%d') <> '02-29' AND b.day = CAST(a.day - INTERVAL 1 YEAR AS DATE)""")
def _(t):
    daily = t.ord.groupBy(F.col("order_date").alias("day")).agg(F.count("*").alias("orders"))
    return joins.year_over_year(calendar_fill(daily, "day", "1 DAY", ["orders"]), "day", "orders")


@query("j19_latest_by_max", """SELECT cust_id, record_id, city, updated_at::VARCHAR AS updated_at FROM #upd
    QUALIFY row_number() OVER (PARTITION BY cust_id ORDER BY updated_at DESC, record_id DESC) = 1""")
def _(t):
    log = t.upd.select("cust_id", "record_id", "city", "updated_at")
    return joins.latest_row(log, "cust_id", ["updated_at", "record_id"])


@query("j20_fanout_report", """WITH l AS (SELECT l_orderkey AS k, count(*) AS l FROM lineitem GROUP BY k),
    r AS (SELECT cust_id AS k, count(*) AS r FROM #ord GROUP BY k)
    SELECT sum(l)::BIGINT AS left_rows, sum(r)::BIGINT AS right_rows, count(*) FILTER (l > 1) AS left_repeated_keys,
    count(*) FILTER (r > 1) AS right_repeated_keys, sum(l * r)::BIGINT AS joined_rows FROM l FULL JOIN r ON l.k = r.k""")
def _(t):
    lines = t["lineitem"].select(F.col("l_orderkey").alias("k"))
    report = joins.fanout_report(lines, t.ord.select(F.col("cust_id").alias("k")), "k")
    return report.withColumn("joined_rows", F.col("joined_rows").cast("long"))


VIEW_TO_PURCHASE = """SELECT a.event_id AS view_id, b.event_id AS purchase_id, a.user_id FROM events a JOIN events b
    ON a.user_id = b.user_id AND a.ts <= b.ts AND b.ts <= a.ts + INTERVAL 1 HOUR
    WHERE a.event_type = 'view' AND b.event_type = 'purchase'"""


@query("j21_interval_join", VIEW_TO_PURCHASE)
def _(t):
    kind = F.col("event_type")
    a = t["events"].where(kind == "view").select("user_id", F.col("event_id").alias("view_id"), F.col("ts").alias("a_ts"))
    b = t["events"].where(kind == "purchase").select(
        "user_id", F.col("event_id").alias("purchase_id"), F.col("ts").alias("b_ts")
    )
    pairs = joins.interval_join(a, b, "user_id", "a_ts", "b_ts", 3600)
    return pairs.select("view_id", "purchase_id", "user_id")
