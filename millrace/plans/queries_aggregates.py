"""Aggregation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import aggregates as agg
from millrace.operators.aggregates import money
from millrace.operators.joins import latest_row
from millrace.operators.windows import Split
from millrace.plans.registry import query
from millrace.plans.shapes import HOT, LONGEST_LIST

STATUSES = ["Completed", "Pending", "Cancelled"]


@query("a01_row_count", "SELECT count(*) AS rows FROM lineitem")
def _(t):
    return agg.row_count(t["lineitem"])


@query("a02_count_where", "SELECT count(*) AS rows FROM #ord WHERE amount > 250000")
def _(t):
    return agg.count_where(t.ord, F.col("amount") > 250000)


@query("a03_count_by", "SELECT city, count(*) AS rows FROM #cust GROUP BY city")
def _(t):
    return agg.count_by(t.cust, ["city"])


@query("a04_count_having", "SELECT cust_id, count(*) AS rows FROM #ord GROUP BY cust_id HAVING count(*) >= 12")
def _(t):
    return agg.count_by(t.ord, ["cust_id"], at_least=12)


@query("a05_sum_by", "SELECT cust_id, sum(money)::DOUBLE AS total FROM #ord GROUP BY cust_id")
def _(t):
    return agg.sum_by(t.ord, ["cust_id"], money("amount"))


@query("a06_avg_by", "SELECT status, sum(money)::DOUBLE / count(money) AS average FROM #ord GROUP BY status")
def _(t):
    return agg.avg_by(t.ord, ["status"], money("amount"))


@query("a07_multi_agg", """SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty,
    sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS sum_price, max(l_shipdate)::VARCHAR AS last_ship,
    min(l_discount) AS least_discount, count(*) AS lines FROM lineitem GROUP BY ALL""")
def _(t):
    return agg.multi_agg(t["lineitem"], ["l_returnflag", "l_linestatus"], {
        "sum_qty": F.sum("l_quantity"), "sum_price": F.sum(money("l_extendedprice")),
        "last_ship": F.max("l_shipdate"), "least_discount": F.min("l_discount"), "lines": F.count("*"),
    })


@query("a08_null_agg", """WITH v AS (SELECT CASE WHEN order_id % 7 <> 0 THEN money END AS m FROM #ord)
    SELECT count(*) AS rows, count(m) AS present, count(*) - count(m) AS missing, sum(m)::DOUBLE AS total,
    sum(m)::DOUBLE / count(m) AS average, sum(m)::DOUBLE / count(*) AS average_as_zero FROM v""")
def _(t):
    holes = t.ord.select(F.when(F.col("order_id") % 7 != 0, money("amount")).alias("m"))
    return agg.null_agg(holes, "m")


@query("a09_rollup", """SELECT city, segment, count(*) AS rows, grouping(city, segment) AS level FROM
    (SELECT n_name AS city, c_mktsegment AS segment FROM customer JOIN nation ON c_nationkey = n_nationkey)
    GROUP BY ROLLUP (city, segment)""")
def _(t):
    segments = t["customer"].select(F.col("c_custkey").alias("cust_id"), F.col("c_mktsegment").alias("segment"))
    return agg.rollup_count(t.cust.join(segments, "cust_id"), ["city", "segment"])


@query("a10_cube", """SELECT city, status, count(*) AS rows, grouping(city, status) AS level FROM #ord JOIN #cust USING (cust_id)
    GROUP BY CUBE (city, status)""")
def _(t):
    return agg.cube_count(t.ord.join(t.cust, "cust_id"), ["city", "status"])


@query("a11_grouping_sets", """SELECT week::VARCHAR AS week, month::VARCHAR AS month, sum(money)::DOUBLE AS total,
    grouping(week, month) AS level FROM (SELECT CAST(date_trunc('week', order_date) AS DATE) AS week,
    CAST(date_trunc('month', order_date) AS DATE) AS month, money FROM #ord) GROUP BY GROUPING SETS ((week), (month))""")
def _(t):
    dated = t.ord.select(
        F.trunc("order_date", "week").alias("week"), F.trunc("order_date", "month").alias("month"), "amount"
    )
    return agg.grouping_sets(dated, [["week"], ["month"]], ["week", "month"], {"total": F.sum(money("amount"))})


_CELLS = ", ".join(f"sum(money) FILTER (status = '{s}')::DOUBLE AS {s}" for s in STATUSES)
_CASES = ", ".join(f"sum(CASE WHEN status = '{s}' THEN money ELSE 0 END)::DOUBLE AS {s}" for s in STATUSES)


@query("a12_pivot", f"SELECT cust_id, {_CELLS} FROM #ord GROUP BY cust_id")
def _(t):
    return agg.pivot_sum(t.ord, "cust_id", "status", STATUSES, money("amount"))


@query("a13_case_pivot", f"SELECT cust_id, {_CASES} FROM #ord GROUP BY cust_id")
def _(t):
    return agg.case_pivot(t.ord, "cust_id", "status", STATUSES, money("amount"))


@query("a14_unpivot", """SELECT l_orderkey, l_partkey, 'l_tax' AS measure, l_tax AS value FROM lineitem
    UNION ALL SELECT l_orderkey, l_partkey, 'l_discount', l_discount FROM lineitem""")
def _(t):
    return agg.unpivot(t["lineitem"], ["l_orderkey", "l_partkey"], ["l_tax", "l_discount"], "measure", "value")


def _lists(source: str, value: str, order: str) -> str:
    return f"""SELECT cust_id, part, array_to_string(list({value} ORDER BY {order}), ',') AS items FROM (SELECT *,
        (row_number() OVER (PARTITION BY cust_id ORDER BY {order}) - 1) // {LONGEST_LIST} AS part FROM {source})
        GROUP BY cust_id, part"""


def _joined(df):
    return df.withColumn("items", F.array_join("items", ","))


@query("a15_collect_list", _lists("#ord", "order_id", "order_id"))
def _(t):
    return _joined(agg.ordered_list(t.ord, "cust_id", "order_id", ["order_id"], Split(), LONGEST_LIST))


@query("a15_collect_set", _lists("(SELECT DISTINCT cust_id, status FROM #ord)", "status", "status"))
def _(t):
    return _joined(agg.distinct_list(t.ord, "cust_id", "status", Split(), LONGEST_LIST))


@query("a16_ordered_list", _lists("#ord", "order_id", "order_date, order_id"))
def _(t):
    return _joined(agg.ordered_list(t.ord, "cust_id", "order_id", ["order_date", "order_id"], Split(), LONGEST_LIST))


@query("a17_distinct_count", "SELECT status, count(DISTINCT cust_id) AS distinct_values FROM #ord GROUP BY status")
def _(t):
    return agg.distinct_count(t.ord, "cust_id", ["status"])


@query("a18_approx_distinct", "SELECT DISTINCT l_returnflag, TRUE AS close FROM lineitem")
def _(t):
    # The sketch's estimate is within four standard deviations of the exact count.
    lines = t["lineitem"]
    near = agg.approx_distinct(lines, "l_partkey", ["l_returnflag"], 0.02).withColumnRenamed("distinct_values", "guess")
    both = near.join(agg.distinct_count(lines, "l_partkey", ["l_returnflag"]), "l_returnflag")
    off = F.abs(F.col("guess") - F.col("distinct_values")) / F.col("distinct_values")
    return both.select("l_returnflag", (off <= 0.08).alias("close"))


_MEDIAN = "SELECT status, median(amount) AS median FROM #ord GROUP BY status"


@query("a19_median", _MEDIAN)
def _(t):
    return agg.median_by(t.ord, "status", "amount", Split())


@query("a19_median_split", _MEDIAN)
def _(t):
    return agg.median_by(t.ord, "status", "amount", Split(hot_rows=HOT))


@query("a20_approx_percentile", "SELECT DISTINCT status, TRUE AS close FROM #ord")
def _(t):
    # The value returned has a rank within rows / accuracy of the one asked for.
    near = agg.approx_percentile_by(t.ord, ["status"], "amount", 0.9, 1000)
    below = t.ord.join(near, "status").groupBy("status").agg(
        F.count("*").alias("n"), F.count_if(F.col("amount") <= F.col("percentile")).alias("upto")
    )
    return below.select("status", (F.abs(F.col("upto") - 0.9 * F.col("n")) <= F.col("n") / 1000 + 1).alias("close"))


@query("a21_agg_of_agg", """SELECT max(total)::DOUBLE AS most, sum(total)::DOUBLE / count(*) AS typical, max(rows) AS most_rows,
    count(*) AS customers FROM (SELECT cust_id, sum(money) AS total, count(*) AS rows FROM #ord GROUP BY cust_id)""")
def _(t):
    return agg.agg_of_agg(t.ord, ["cust_id"], money("amount"), {
        "most": F.max("total"), "typical": agg.mean(F.col("total")), "most_rows": F.max("rows"),
        "customers": F.count("*"),
    })


@query("a22_map_totals", """SELECT cust_id, string_agg(status || '=' || total, ';' ORDER BY status) AS totals FROM
    (SELECT cust_id, status, sum(money) AS total FROM #ord GROUP BY cust_id, status) GROUP BY cust_id""")
def _(t):
    maps = agg.map_totals(t.ord, "cust_id", "status", money("amount"))
    text = F.transform(F.map_entries("totals"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return maps.select("cust_id", F.array_join(text, ";").alias("totals"))


@query("a23_reduce_rows", """SELECT cust_id, order_id, amount FROM #ord
    QUALIFY row_number() OVER (PARTITION BY cust_id ORDER BY amount DESC, order_id DESC) = 1""")
def _(t):
    return latest_row(t.ord.select("cust_id", "order_id", "amount"), "cust_id", ["amount", "order_id"])


@query("a24_merge_aggregate", "SELECT cust_id, count(*) AS orders, sum(money)::DOUBLE AS total FROM #ord GROUP BY cust_id")
def _(t):
    def totals(df):
        return df.groupBy("cust_id").agg(F.count("*").alias("orders"), F.sum(money("amount")).alias("total"))

    new = F.col("order_date") >= F.lit("2001-01-01").cast("date")
    return agg.merge_aggregate(totals(t.ord.where(~new)), totals(t.ord.where(new)), ["cust_id"], ["orders", "total"])


@query("a25_counted", """SELECT count(*) FILTER (event_type = 'error') AS errors, count(*) FILTER (value > 20) AS large,
    count(*) FILTER (props NOT LIKE '{%') AS malformed FROM events""")
def _(t):
    return agg.counted(t["events"], {
        "errors": F.col("event_type") == "error", "large": F.col("value") > 20, "malformed": ~F.col("props").startswith("{"),
    })
