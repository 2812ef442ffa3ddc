"""Subquery, staged-step and hierarchy queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import hierarchy, subqueries
from millrace.operators.aggregates import count_by, mean, money
from millrace.operators.windows import global_ranks
from millrace.plans.registry import query
from millrace.session import shared_path


@query("q01_single_step", """WITH totals AS (SELECT cust_id, sum(money) AS total FROM #ord GROUP BY cust_id)
    SELECT cust_id, total::DOUBLE AS total FROM totals WHERE total > 3000000""")
def _(t):
    totals = t.ord.groupBy("cust_id").agg(F.sum(money("amount")).alias("total"))
    return totals.where(F.col("total") > 3_000_000)


@query("q02_ranked_steps", """WITH clean AS (SELECT * FROM #ord WHERE status <> 'Cancelled' AND amount IS NOT NULL),
    once AS (SELECT DISTINCT order_id, cust_id, money FROM clean),
    totals AS (SELECT cust_id, floor(sum(money)::DOUBLE / 10000)::BIGINT AS total FROM once GROUP BY cust_id)
    SELECT cust_id, total, dense_rank() OVER (ORDER BY total DESC) AS amt_rank FROM totals""")
def _(t):
    def clean(df):
        return df.where((F.col("status") != "Cancelled") & F.col("amount").isNotNull())

    def totals(df):
        total = F.floor(F.sum(money("amount")).cast("double") / 10000).cast("bigint")
        return df.groupBy("cust_id").agg(total.alias("total"))

    summed = t.ord.transform(clean).select("order_id", "cust_id", "amount").distinct().transform(totals)
    return global_ranks(summed, "total").select("cust_id", "total", F.col("dense_rank").alias("amt_rank"))


@query("q03_shared_step", """WITH heavy AS (SELECT cust_id, count(*) AS order_cnt, sum(money) AS total_amt FROM #ord
    GROUP BY cust_id) SELECT a.cust_id, b.order_cnt, a.total_amt::DOUBLE AS total_amt,
    (SELECT max(order_cnt) FROM heavy) AS most_orders FROM heavy a JOIN heavy b USING (cust_id)""")
def _(t):
    # One aggregation answers both uses of the step, so it is neither planned nor run twice.
    heavy = t.ord.groupBy("cust_id").agg(F.count("*").alias("order_cnt"), F.sum(money("amount")).alias("total_amt"))
    return subqueries.with_global(heavy, heavy, {"most_orders": F.max("order_cnt")})


@query("q04_staged_counts", """WITH big AS (SELECT city, count(*) AS cust_cnt FROM #cust GROUP BY city HAVING count(*) > 55)
    SELECT city, cust_cnt FROM big UNION ALL SELECT 'all', count(*) FROM big""")
def _(t):
    # Staged as a table that two queries read, so the grouping runs once.
    staged = shared_path(t.spark, "big-cities")
    count_by(t.cust, ["city"], at_least=56).withColumnRenamed("rows", "cust_cnt").write.parquet(staged)
    big = t.spark.read.parquet(staged)
    return big.unionByName(big.agg(F.lit("all").alias("city"), F.count("*").alias("cust_cnt")))


@query("q05_with_global", """SELECT order_id, amount, (SELECT sum(money)::DOUBLE / count(*) FROM #ord) AS avg_order_amt,
    (SELECT count(*) FROM #ord) AS order_cnt FROM #ord""")
def _(t):
    aggs = {"avg_order_amt": mean(money("amount")), "order_cnt": F.count("*")}
    return subqueries.with_global(t.ord.select("order_id", "amount"), t.ord, aggs)


@query("q06_above_average", "SELECT order_id, cust_id, amount FROM #ord WHERE amount > (SELECT sum(money)::DOUBLE / count(*) FROM #ord)")
def _(t):
    orders = t.ord.select("order_id", "cust_id", "amount")
    return subqueries.above(orders, F.col("amount"), mean(money("amount")))


@query("q07_in_subquery", "SELECT cust_id, cust_name FROM #cust WHERE cust_id IN (SELECT cust_id FROM #ord WHERE status = 'Cancelled')")
def _(t):
    cancelled = t.ord.where(F.col("status") == "Cancelled")
    return subqueries.in_subquery(t.cust.select("cust_id", "cust_name"), "cust_id", cancelled, "cust_id")


_OUTER = "SELECT nullif(cust_id, 3) AS cust_id, cust_name FROM #cust"
_LIST = {
    "null": "SELECT CASE WHEN amount <= 499900 THEN cust_id END FROM #ord WHERE amount > 450000",
    "full": "SELECT cust_id FROM #ord WHERE amount > 450000",
    "empty": "SELECT cust_id FROM #ord WHERE amount < 0",
}


def _not_in(t, which):
    listed = {
        "null": t.ord.where("amount > 450000").withColumn(
            "cust_id", F.when(F.col("amount") <= 499900, F.col("cust_id"))
        ),
        "full": t.ord.where("amount > 450000"),
        "empty": t.ord.where("amount < 0"),
    }[which]
    outer = t.cust.select(F.nullif("cust_id", F.lit(3)).alias("cust_id"), "cust_name")
    return subqueries.not_in(outer, "cust_id", listed, "cust_id")


def _register_not_in(which):
    query(f"q08_not_in_{which}", f"SELECT * FROM ({_OUTER}) WHERE cust_id NOT IN ({_LIST[which]})")(
        lambda t: _not_in(t, which)
    )


for _which in _LIST:
    _register_not_in(_which)


@query("q09_exists", """SELECT cust_id, cust_name FROM #cust c WHERE EXISTS
    (SELECT 1 FROM #ord o WHERE o.cust_id = c.cust_id AND o.amount > 480000)""")
def _(t):
    return subqueries.exists(t.cust.select("cust_id", "cust_name"), t.ord.where("amount > 480000"), "cust_id")


@query("q10_not_exists", f"""SELECT * FROM ({_OUTER}) c WHERE NOT EXISTS
    (SELECT 1 FROM #ord o WHERE o.cust_id = c.cust_id AND o.amount > 480000)""")
def _(t):
    outer = t.cust.select(F.nullif("cust_id", F.lit(3)).alias("cust_id"), "cust_name")
    return subqueries.not_exists(outer, t.ord.where("amount > 480000"), "cust_id")


@query("q11_correlated_agg", """WITH u AS (SELECT cust_id FROM #cust UNION ALL SELECT -1)
    SELECT cust_id, (SELECT count(*) FROM #ord o WHERE o.cust_id = u.cust_id) AS order_cnt,
    (SELECT max(order_date) FROM #ord o WHERE o.cust_id = u.cust_id)::VARCHAR AS last_order FROM u""")
def _(t):
    outer = t.cust.select("cust_id").unionByName(t.spark.range(-1, 0).withColumnRenamed("id", "cust_id"))
    aggs = {"order_cnt": F.count("*"), "last_order": F.max("order_date")}
    return subqueries.correlated(outer, t.ord, "cust_id", aggs, zero=["order_cnt"])


@query("q12_where_count_gt", """SELECT cust_id, cust_name FROM #cust c
    WHERE (SELECT count(*) FROM #ord o WHERE o.cust_id = c.cust_id) > 12""")
def _(t):
    return subqueries.where_count_gt(t.cust.select("cust_id", "cust_name"), t.ord, "cust_id", 12).drop("rows")


@query("q13_derived_total", """SELECT cust_id, total::DOUBLE AS total FROM (SELECT cust_id, sum(money) AS total FROM #ord
    GROUP BY cust_id) d WHERE total > (SELECT sum(money) / count(DISTINCT cust_id) FROM #ord)""")
def _(t):
    totals = t.ord.groupBy("cust_id").agg(F.sum(money("amount")).alias("total"))
    return subqueries.above(totals, F.col("total").cast("double"), mean(F.col("total")))


@query("q14_lateral_top", """SELECT c.cust_id, o.order_id, o.amount, o.place FROM
    (SELECT cust_id FROM #cust UNION ALL SELECT s_suppkey + 1000000000 FROM supplier) c LEFT JOIN (SELECT *, row_number() OVER
    (PARTITION BY cust_id ORDER BY amount DESC, order_id) AS place FROM #ord) o
    ON o.cust_id = c.cust_id AND place <= 2""")
def _(t):
    # Suppliers, numbered beyond the customers, have no orders.
    people = t.cust.select("cust_id").unionByName(t["supplier"].select((F.col("s_suppkey") + 1_000_000_000).alias("cust_id")))
    return subqueries.lateral_top(people, t.ord.select("cust_id", "order_id", "amount"), "cust_id", ["-amount", "order_id"], 2)


_REACHED = """WITH RECURSIVE reached AS (SELECT emp_id AS node, 0 AS level, emp_id::VARCHAR AS path FROM #tree
    WHERE mgr_id = -1 UNION ALL SELECT e.emp_id, r.level + 1, r.path || '/' || e.emp_id FROM reached r
    JOIN #tree e ON e.mgr_id = r.node) SELECT node, level, path FROM reached"""


@query("h01_levels_fixed", _REACHED + " WHERE level < 3")
def _(t):
    return hierarchy.levels_fixed(t.tree, "emp_id", "mgr_id", -1, 3)


@query("h02_walk", _REACHED)
def _(t):
    return hierarchy.walk(t.tree, "emp_id", "mgr_id", -1)


@query("h02_walk_null_root", _REACHED)
def _(t):
    boss = F.when(F.col("mgr_id") >= 0, F.col("mgr_id"))
    return hierarchy.walk(t.tree.withColumn("mgr_id", boss), "emp_id", "mgr_id", None)


@query("h03_walk_sql", _REACHED)
def _(t):
    return hierarchy.walk_sql(t.spark, t.tree, "emp_id", "mgr_id", -1)


