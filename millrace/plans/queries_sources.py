"""Source and sink queries: what was written is read back and compared with the table."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.aggregates import money
from millrace.plans.registry import query
from millrace.session import shared_path
from millrace.sources import files, tables
from millrace.sources.versions import VersionedTable

_ORDERS = "order_id long, cust_id long, order_date date, amount double, status string"
_ALL_ORDERS = "SELECT order_id, cust_id, order_date::VARCHAR AS order_date, amount, status FROM #ord"


@query("s01_scan", "SELECT * REPLACE (o_orderdate::VARCHAR AS o_orderdate) FROM orders")
def _(t):
    return files.scan(t.spark, t.folder, "orders")


@query("s02_number_range", """SELECT i AS id FROM range(0, (SELECT max(order_id) + 1 FROM #ord)) r(i)
    WHERE i NOT IN (SELECT l_orderkey FROM lineitem)""")
def _(t):
    # Order numbers without a line: the range is as long as the order table.
    last = t.ord.agg(F.max("order_id").alias("last")).first()["last"]
    ids = tables.number_range(t.spark, 0, last + 1)
    return ids.join(t["lineitem"].select(F.col("l_orderkey").alias("id")), "id", "left_anti")


@query("s03_inline_table", """SELECT meaning, count(*) AS orders FROM #ord JOIN (VALUES ('Completed', 'paid'),
    ('Pending', 'open'), ('Cancelled', 'void')) v(status, meaning) USING (status) GROUP BY meaning""")
def _(t):
    meanings = [("Completed", "paid"), ("Pending", "open"), ("Cancelled", "void")]
    codes = tables.inline_table(t.spark, meanings, "status string, meaning string")
    return t.ord.join(codes, "status").groupBy("meaning").agg(F.count("*").alias("orders"))


@query("s04_json", _ALL_ORDERS)
def _(t):
    path = shared_path(t.spark, "json")
    files.write_json(t.ord, path)
    return files.read_json(t.spark, path, _ORDERS)


@query("s04_json_inferred", "SELECT status, count(*) AS rows, sum(money)::DOUBLE AS total FROM #ord GROUP BY status")
def _(t):
    path = shared_path(t.spark, "json")
    files.write_json(t.ord, path)
    return files.read_json(t.spark, path).groupBy("status").agg(
        F.count("*").alias("rows"), F.sum(money("amount")).alias("total")
    )


@query("s05_csv_inferred", _ALL_ORDERS)
def _(t):
    path = shared_path(t.spark, "csv")
    files.write_csv(t.ord, path)
    return files.read_csv_inferred(t.spark, path)


@query("s06_csv", _ALL_ORDERS)
def _(t):
    path = shared_path(t.spark, "csv")
    files.write_csv(t.ord, path)
    return files.read_csv(t.spark, path, _ORDERS)


@query("s07_rejects", """SELECT CASE WHEN order_id % 4 = 0 THEN 'good' ELSE 'bad' END AS kind, count(*) AS rows,
    sum(order_id)::BIGINT AS ids FROM #ord GROUP BY kind""")
def _(t):
    path = shared_path(t.spark, "csv")
    files.write_csv(t.raw_dates, path)
    good, bad = files.read_with_rejects(t.spark, path, "id long, value date")
    # Only a quarter of the texts are dates in the schema's own format.
    lines = good.select("id", F.lit("good").alias("kind")).unionByName(
        bad.select(F.split("line", ",")[0].cast("long").alias("id"), F.lit("bad").alias("kind"))
    )
    return lines.groupBy("kind").agg(F.count("*").alias("rows"), F.sum("id").alias("ids"))


@query("s08_partitioned", _ALL_ORDERS)
def _(t):
    path = shared_path(t.spark, "parquet")
    files.write_parquet(t.ord, path, ["status"])
    return t.spark.read.parquet(path)


@query("s09_filtered_scan", "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_quantity >= 45 AND l_returnflag = 'R'")
def _(t):
    wanted = (F.col("l_quantity") >= 45) & (F.col("l_returnflag") == "R")
    return files.filtered_scan(t.spark, f"{t.folder}/lineitem.parquet", wanted, ["l_orderkey", "l_quantity"])


def _partitioned_events(t):
    path = shared_path(t.spark, "events")
    files.write_parquet(t["events"].withColumn("day", F.to_date("ts")), path, ["day"])
    return path


@query("s10_pruned_scan", """SELECT event_id, user_id FROM events
    WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-09'""")
def _(t):
    recent = F.col("day").between("2024-01-05", "2024-01-09")
    return files.pruned_scan(t.spark, _partitioned_events(t), recent).select("event_id", "user_id")


@query("s11_orc", _ALL_ORDERS)
def _(t):
    path = shared_path(t.spark, "orc")
    files.write_orc(t.ord, path)
    return files.read_orc(t.spark, path)


@query("s12_bucketed", "SELECT cust_id, count(*) AS orders FROM #ord GROUP BY cust_id")
def _(t):
    name = shared_path(t.spark, "orders").rsplit("/", 1)[1].replace("-", "_")
    tables.write_bucketed(t.ord, name, 8, ["cust_id"], ["order_date"])
    return t.spark.table(name).groupBy("cust_id").agg(F.count("*").alias("orders"))


@query("s13_lines", "SELECT value FROM #logs")
def _(t):
    path = shared_path(t.spark, "text")
    t.logs.select("value").write.text(path)
    return files.read_lines(t.spark, path)


@query("s14_write_sized", "SELECT count(*) AS rows, TRUE AS within FROM #ord")
def _(t):
    path = shared_path(t.spark, "sized")
    files.write_sized(t.ord, path, 2000)
    per_file = t.spark.read.parquet(path).groupBy("_metadata.file_path").agg(F.count("*").alias("n"))
    return per_file.agg(F.sum("n").alias("rows"), (F.max("n") <= 2000).alias("within"))


@query("s15_compact", "SELECT count(*) AS rows, sum(money)::DOUBLE AS total, TRUE AS fewer FROM #ord")
def _(t):
    many, few = shared_path(t.spark, "many"), shared_path(t.spark, "few")
    t.ord.repartition(40).write.parquet(many)
    files.compact(t.spark, many, few)
    return t.spark.read.parquet(few).agg(
        F.count("*").alias("rows"), F.sum(money("amount")).alias("total"),
        (F.count_distinct(F.col("_metadata.file_path")) <= 40).alias("fewer"),
    )


@query("s16_read_merged", """SELECT order_id, amount, CASE WHEN order_date < DATE '1998-01-01' THEN 'unknown' ELSE status END AS status
    FROM #ord""")
def _(t):
    path = shared_path(t.spark, "merged")
    old = F.col("order_date") < "1998-01-01"
    t.ord.where(old).select("order_id", "amount").write.parquet(f"{path}/load=1")
    t.ord.where(~old).select("order_id", "amount", "status").write.parquet(f"{path}/load=2")
    return files.read_merged(t.spark, path, {"status": F.lit("unknown")}).drop("load")


@query("s15_compact_partitioned", "SELECT order_id, amount, status FROM #ord")
def _(t):
    many, few = shared_path(t.spark, "many"), shared_path(t.spark, "few")
    t.ord.select("order_id", "amount", "status").repartition(20).write.partitionBy("status").parquet(many)
    files.compact(t.spark, many, few, partitions=["status"])
    return t.spark.read.parquet(few)


@query("s16_read_widened", "SELECT order_id, amount FROM #ord")
def _(t):
    path = shared_path(t.spark, "widened")
    old = F.col("order_date") < "1998-01-01"
    t.ord.where(old).select(F.col("order_id").cast("int").alias("order_id"), "amount").write.parquet(f"{path}/load=1")
    t.ord.where(~old).select(F.col("order_id").cast("long").alias("order_id"), "amount").write.parquet(f"{path}/load=2")
    return files.read_merged(t.spark, path, {}, "order_id long, amount double").select("order_id", "amount")


@query("s17_overwrite_partitions", """SELECT order_id, CASE WHEN status = 'Pending' THEN amount + 1 ELSE amount END AS amount, status
    FROM #ord""")
def _(t):
    path = shared_path(t.spark, "parts")
    orders = t.ord.select("order_id", "amount", "status")
    files.write_parquet(orders, path, ["status"])
    corrected = orders.where(F.col("status") == "Pending").withColumn("amount", F.col("amount") + 1)
    files.overwrite_partitions(corrected, path, ["status"])
    return t.spark.read.parquet(path)


@query("s17_overwrite_versions", """SELECT order_id, CASE WHEN status = 'Pending' THEN amount + 1 ELSE amount END AS amount, status
    FROM #ord WHERE status <> 'Cancelled'""")
def _(t):
    orders = t.ord.select("order_id", "amount", "status")
    table = VersionedTable.create(orders, shared_path(t.spark, "orders"), ["status"])
    base = table.manifest()
    corrected = table.read(base).where(F.col("status") == "Pending").withColumn("amount", F.col("amount") + 1)
    cancelled = table.labels(orders.where(F.col("status") == "Cancelled"), base)
    table.replace(corrected, cancelled, base)
    return table.read()


@query("s18_ctas", "SELECT city, count(*) AS customers FROM #cust GROUP BY city")
def _(t):
    name = shared_path(t.spark, "cities").rsplit("/", 1)[1].replace("-", "_")
    return tables.ctas(t.spark, name, t.cust.groupBy("city").agg(F.count("*").alias("customers")))


@query("s21_save_mode", "SELECT order_id, status FROM #ord WHERE status IN ('Pending', 'Cancelled')")
def _(t):
    path = shared_path(t.spark, "modes")
    orders = t.ord.select("order_id", "status")
    files.write_parquet(orders, path)
    files.write_parquet(orders.where(F.col("status") == "Pending"), path, mode="overwrite")
    files.write_parquet(orders.where(F.col("status") == "Cancelled"), path, mode="append")
    return t.spark.read.parquet(path)
