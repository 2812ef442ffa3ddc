"""Row operators: projections, filters, sorting, set operations."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from millrace.operators import layout, rows, sets, topk
from millrace.operators.aggregates import money
from millrace.operators.skew import hot_keys, row_salt
from millrace.operators.subqueries import reused, scalar
from millrace.plans.registry import query


@query("p01_project", "SELECT cust_id, city FROM #cust")
def _(t):
    return rows.project(t.cust, ["cust_id", "city"])


@query("p02_derive", """SELECT order_id, cust_id AS customer, amount * 2 AS double_amount,
    'Order_' || order_id AS label FROM #ord""")
def _(t):
    df = rows.derive(
        t.ord,
        {"double_amount": F.col("amount") * 2, "label": F.concat(F.lit("Order_"), F.col("order_id"))},
        {"cust_id": "customer"},
    )
    return df.select("order_id", "customer", "double_amount", "label")


@query("p03_where_eq", "SELECT cust_id, cust_name, city FROM #cust WHERE city = 'NATION_3'")
def _(t):
    return rows.where_eq(t.cust, "city", "NATION_3").select("cust_id", "cust_name", "city")


@query("p04_where_any", "SELECT cust_id, city FROM #cust WHERE city = 'NATION_3' OR city = 'NATION_7'")
def _(t):
    return rows.where_any(t.cust, [F.col("city") == "NATION_3", F.col("city") == "NATION_7"]).select("cust_id", "city")


@query("p05_where_all", "SELECT cust_id, city FROM #cust WHERE city = 'NATION_3' AND cust_id > 50")
def _(t):
    return rows.where_all(t.cust, [F.col("city") == "NATION_3", F.col("cust_id") > 50]).select("cust_id", "city")


@query("p06_where_between", "SELECT order_id, amount FROM #ord WHERE amount BETWEEN 100000 AND 200000")
def _(t):
    return rows.where_between(t.ord, "amount", 100000, 200000).select("order_id", "amount")


@query("p07_where_prefix", "SELECT record_id, cust_name FROM #upd WHERE starts_with(cust_name, 'Customer_1')")
def _(t):
    return rows.where_prefix(t.upd.select("record_id", "cust_name"), "cust_name", "Customer_1")


@query("p08_where_in", "SELECT cust_id, city FROM #cust WHERE city IN ('NATION_1', 'NATION_2', 'NATION_5')")
def _(t):
    return rows.where_in(t.cust, "city", ["NATION_1", "NATION_2", "NATION_5"]).select("cust_id", "city")


@query("p09_where_null", """SELECT cust_id, 'missing' AS kind FROM #nulls WHERE city IS NULL
    UNION ALL SELECT cust_id, 'present' FROM #nulls WHERE city IS NOT NULL""")
def _(t):
    missing = rows.where_null(t.nulls, "city").select("cust_id", F.lit("missing").alias("kind"))
    return missing.unionByName(
        rows.where_null(t.nulls, "city", negate=True).select("cust_id", F.lit("present").alias("kind"))
    )


@query("p10_case_when", """SELECT order_id, CASE WHEN amount > 400000 THEN 'large' WHEN amount > 150000 THEN 'medium'
    ELSE 'small' END AS size FROM #ord""")
def _(t):
    branches = [(F.col("amount") > 400000, "large"), (F.col("amount") > 150000, "medium")]
    return rows.case_when(t.ord, "size", branches, "small").select("order_id", "size")


@query("p11_map_filter", "SELECT order_id * order_id AS square FROM #ord WHERE (order_id * order_id) % 2 = 0")
def _(t):
    return rows.map_filter(t.ord, {"square": F.col("order_id") * F.col("order_id")}, F.col("square") % 2 == 0)


@query("p12_expand", """SELECT order_id, unnest([order_id, order_id * 10]) AS n FROM #ord""")
def _(t):
    return rows.expand(t.ord.select("order_id"), F.array(F.col("order_id"), F.col("order_id") * 10), "n")


def _load_table() -> pa.Table:
    # Fixed value: the share of an order each status is weighted with.
    return pa.table({"status": ["Completed", "Pending", "Cancelled"], "weight": [1.0, 0.5, 0.0]})


def _weigh(weights: pa.Table, batch: pa.RecordBatch) -> pa.RecordBatch:
    at = pc.index_in(batch["status"], weights["status"].combine_chunks())
    weighted = pc.multiply(batch["amount"], pc.take(weights["weight"].combine_chunks(), at))
    return pa.record_batch({"order_id": batch["order_id"], "weighted": weighted})


@query("p13_map_batches", """SELECT order_id, amount * CASE status WHEN 'Completed' THEN 1.0::DOUBLE
    WHEN 'Pending' THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS weighted FROM #ord""")
def _(t):
    return rows.map_batches(
        t.ord.select("order_id", "status", "amount"), _load_table, _weigh, "order_id long, weighted double"
    )


@query("p14_where_false", "SELECT order_id, amount FROM #ord WHERE 1 = 0")
def _(t):
    return rows.where_false(t.ord).select("order_id", "amount")


@query("j08_value_grid", """SELECT c.cust_id, v.status, count(o.order_id) AS orders
    FROM #cust c CROSS JOIN (VALUES ('Completed'), ('Pending'), ('Cancelled')) v(status)
    LEFT JOIN #ord o ON o.cust_id = c.cust_id AND o.status = v.status GROUP BY c.cust_id, v.status""")
def _(t):
    grid = rows.pair_with_values(t.cust.select("cust_id"), ["Completed", "Pending", "Cancelled"], "status")
    counts = t.ord.groupBy("cust_id", "status").agg(F.count("*").alias("orders"))
    return grid.join(counts, ["cust_id", "status"], "left").fillna(0, ["orders"])


@query("o01_sort_by", "SELECT cust_id, city, signup_date::VARCHAR AS signup_date FROM #cust")
def _(t):
    return topk.sort_by(t.cust.select("cust_id", "city", "signup_date"), ["city", "-signup_date", "cust_id"])


@query("o02_top_n", "SELECT order_id, amount FROM #ord ORDER BY amount DESC, order_id LIMIT 20")
def _(t):
    return topk.top_n(t.ord.select("order_id", "amount"), ["-amount", "order_id"], 20)


@query("o03_best_per_key", """SELECT cust_id, order_id, amount FROM #ord
    QUALIFY row_number() OVER (PARTITION BY cust_id ORDER BY amount DESC, order_id) = 1""")
def _(t):
    return topk.best_per_key(t.ord.select("cust_id", "order_id", "amount"), ["cust_id"], ["-amount", "order_id"])


def _ranked(fn: str) -> str:
    return f"""SELECT l_suppkey, l_partkey, l_quantity, position FROM (SELECT *, {fn}() OVER (
        PARTITION BY l_suppkey ORDER BY l_quantity DESC) AS position FROM
        (SELECT l_suppkey, l_partkey, sum(l_quantity) AS l_quantity FROM lineitem GROUP BY ALL)) WHERE position <= 3"""


def _part_sales(t):
    return t["lineitem"].groupBy("l_suppkey", "l_partkey").agg(F.sum("l_quantity").alias("l_quantity"))


@query("o04_top_n_rank", _ranked("rank"))
def _(t):
    return topk.top_n_per_key(_part_sales(t), ["l_suppkey"], ["-l_quantity"], 3, "rank")


@query("o04_top_n_rank_ties", _ranked("rank"))
def _(t):
    return topk.top_ties_per_key(_part_sales(t), ["l_suppkey"], ["-l_quantity"], 3, "rank", ["l_partkey"])


@query("o04_top_n_dense_ties", _ranked("dense_rank"))
def _(t):
    return topk.top_ties_per_key(_part_sales(t), ["l_suppkey"], ["-l_quantity"], 3, "dense_rank", ["l_partkey"])


@query("o04_top_n_dense", _ranked("dense_rank"))
def _(t):
    return topk.top_n_per_key(_part_sales(t), ["l_suppkey"], ["-l_quantity"], 3, "dense_rank")


@query("o04_top_n_rows", _ranked("row_number").replace("l_quantity DESC)", "l_quantity DESC, l_partkey)"))
def _(t):
    return topk.top_n_per_key(_part_sales(t), ["l_suppkey"], ["-l_quantity", "l_partkey"], 3)


@query("o05_top_n_two_pass", """SELECT status, order_id, amount, position FROM (SELECT *, row_number() OVER (
    PARTITION BY status ORDER BY amount DESC, order_id) AS position FROM #ord) WHERE position <= 10""")
def _(t):
    orders = t.ord.select("status", "order_id", "amount")
    return topk.top_n_two_pass(orders, ["status"], ["-amount", "order_id"], 10, ["order_id"])


@query("o06_range_sort", "SELECT order_id, amount FROM #ord")
def _(t):
    return topk.range_sort(t.ord.select("order_id", "amount"), "order_id", 8)


@query("o07_top_buyers", """WITH spent AS (SELECT o.cust_id, c.city, sum(money) AS spent FROM #ord o
    JOIN #cust c USING (cust_id) GROUP BY ALL)
    SELECT city, cust_id, spent::DOUBLE AS spent, position, country_total::DOUBLE AS country_total FROM (SELECT *,
    row_number() OVER (PARTITION BY city ORDER BY spent DESC, cust_id) AS position,
    sum(spent) OVER (PARTITION BY city) AS country_total FROM spent) WHERE position <= 3""")
def _(t):
    return topk.top_buyers(t.ord, t.cust.select("cust_id", "city"), "cust_id", "city", money("amount"), 3)


@query("u01_distinct", "SELECT DISTINCT cust_id, status FROM #ord")
def _(t):
    return sets.distinct_rows(t.ord, ["cust_id", "status"])


def _two(t):
    big = t.ord.where(F.col("amount") > 300000)
    done = t.ord.where(F.col("status") == "Completed")
    return big.select("cust_id"), done.select("cust_id")


_A = "(SELECT cust_id FROM #ord WHERE amount > 300000)"
_B = "(SELECT cust_id FROM #ord WHERE status = 'Completed')"


@query("u02_union_by_name", """SELECT cust_id, cust_name, city FROM #cust
    UNION ALL SELECT s_suppkey, s_name, 'supplier' FROM supplier""")
def _(t):
    other = t["supplier"].select(
        F.lit("supplier").alias("city"), F.col("s_name").alias("cust_name"), F.col("s_suppkey").alias("cust_id")
    )
    return sets.union_by_name(t.cust.select("cust_id", "cust_name", "city"), other)


@query("u03_union_all", f"{_A} UNION ALL {_B}")
def _(t):
    return sets.union_all(*_two(t))


@query("u04_union_distinct", f"{_A} UNION {_B}")
def _(t):
    return sets.union_distinct(*_two(t))


@query("u05_intersect", f"{_A} INTERSECT {_B}")
def _(t):
    return sets.intersect(*_two(t))


@query("u06_except", f"{_A} EXCEPT {_B}")
def _(t):
    return sets.except_rows(*_two(t))


@query("u06_except_keep", f"SELECT cust_id FROM {_A} a WHERE NOT EXISTS (SELECT 1 FROM {_B} b WHERE a.cust_id = b.cust_id)")
def _(t):
    return sets.except_rows(*_two(t), keep_duplicates=True)


@query("u07_reconcile", """WITH a AS (SELECT order_id, amount, status FROM #ord WHERE status <> 'Cancelled'),
    b AS (SELECT order_id, CASE WHEN status = 'Pending' THEN amount + 1 ELSE amount END AS amount, status
          FROM #ord WHERE order_date < DATE '2001-01-01')
    SELECT * FROM (SELECT coalesce(a.order_id, b.order_id) AS order_id, CASE WHEN b.order_id IS NULL THEN 'only_left'
    WHEN a.order_id IS NULL THEN 'only_right' WHEN a.amount <> b.amount OR a.status <> b.status THEN 'changed' END
    AS status FROM a FULL JOIN b ON a.order_id = b.order_id) WHERE status IS NOT NULL""")
def _(t):
    corrected = F.when(F.col("status") == "Pending", F.col("amount") + 1).otherwise(F.col("amount"))
    a = t.ord.where(F.col("status") != "Cancelled").select("order_id", "amount", "status")
    b = t.ord.where(F.col("order_date") < "2001-01-01").select("order_id", corrected.alias("amount"), "status")
    return sets.reconcile(a, b, "order_id")


@query("k03_range_profile", """SELECT count(*) AS rows, min(order_id) AS lowest, max(order_id) AS highest FROM #ord""")
def _(t):
    parts = layout.range_profile(t.ord, "order_id", 8)
    return parts.agg(F.sum("rows").alias("rows"), F.min("lowest").alias("lowest"), F.max("highest").alias("highest"))


@query("k06_hot_keys", """SELECT k, count(*) AS rows, count(*) / (SELECT count(*) FROM #hot) AS share FROM #hot
    GROUP BY k HAVING share >= 0.01""")
def _(t):
    return hot_keys(t.hot, "k", 0.01)




@query("k01_repartition", "SELECT status, count(*) AS rows FROM #ord GROUP BY status")
def _(t):
    # Rows per partition after a shuffle by key, where each status sits in one partition.
    by_key = layout.repartition_by(t.ord.select("status"), keys=["status"])
    return by_key.groupBy("status", F.spark_partition_id()).agg(F.count("*").alias("rows")).select("status", "rows")


@query("k02_shrink", "SELECT count(*) AS rows, TRUE AS few FROM #ord")
def _(t):
    profile = layout.partition_profile(layout.shrink(layout.repartition_by(t.ord, 12), 3))
    return profile.agg(F.sum("rows").alias("rows"), (F.count("*") <= 3).alias("few"))


@query("k04_reused", "SELECT city, cust_cnt, cust_cnt * 1.0::DOUBLE / (SELECT max(n) FROM (SELECT count(*) AS n FROM #cust GROUP BY city)) "
       "AS share FROM (SELECT city, count(*) AS cust_cnt FROM #cust GROUP BY city)")
def _(t):
    counts = t.cust.groupBy("city").agg(F.count("*").alias("cust_cnt"))
    with reused(counts) as kept:
        most = scalar(kept, F.max("cust_cnt"))
        # Stored before the cache is released, as the result is read later.
        return layout.cut_lineage(kept.withColumn("share", F.col("cust_cnt") / most))


@query("k05_cut_lineage", "SELECT cust_id, count(*) AS orders FROM #ord GROUP BY cust_id")
def _(t):
    return layout.cut_lineage(t.ord.groupBy("cust_id").agg(F.count("*").alias("orders")))


@query("f09_row_salt", "SELECT count(*) AS rows, 16 AS salts, TRUE AS even FROM #ord")
def _(t):
    counts = t.ord.select(row_salt(["order_id"], 16).alias("salt")).groupBy("salt").agg(F.count("*").alias("n"))
    return counts.agg(
        F.sum("n").alias("rows"), F.count("*").alias("salts"), (F.max("n") <= 2 * F.avg("n")).alias("even")
    )
