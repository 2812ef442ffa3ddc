"""The test tables in the shapes the operators are shown on, for Spark and as SQL."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.aggregates import ordered_list
from millrace.operators.windows import Split
from millrace.sources.files import scan

# The `_split` queries treat groups of this many rows as hot, so that small test
# data goes through the split path; on large tables the share of all rows a hot
# key must hold (`skew.HOT_SHARE`) takes over.
HOT = 5
LONGEST_LIST = 10_000


class Tables:
    """Lazy access to the tables of one folder and to the shapes built from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getitem__(self, name: str) -> DataFrame:
        return scan(self.spark, self.folder, name)

    @cached_property
    def cust(self) -> DataFrame:
        c = self["customer"].join(self["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
        start = F.lit("2024-01-01").cast("date")
        return c.select(
            F.col("c_custkey").alias("cust_id"), F.col("c_name").alias("cust_name"), F.col("n_name").alias("city"),
            F.date_add(start, (F.col("c_custkey") % 365).cast("int")).alias("signup_date"),
        )

    @cached_property
    def ord(self) -> DataFrame:
        status = F.col("o_orderstatus")
        return self["orders"].select(
            F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("cust_id"),
            F.to_date("o_orderdate").alias("order_date"), F.col("o_totalprice").alias("amount"),
            F.when(status == "F", "Completed").when(status == "O", "Pending").otherwise("Cancelled").alias("status"),
        )

    @cached_property
    def upd(self) -> DataFrame:
        kind = F.col("event_type")
        return self["events"].select(
            F.col("event_id").alias("record_id"), F.col("user_id").alias("cust_id"),
            F.concat(F.lit("Customer_"), F.col("user_id")).alias("cust_name"), kind.alias("city"),
            F.col("ts").alias("updated_at"),
            F.when(kind == "signup", "INSERT").when(kind == "error", "DELETE").otherwise("UPDATE").alias("operation"),
        )

    @cached_property
    def redelivered(self) -> DataFrame:
        return self.upd.unionByName(self.upd.where(F.col("record_id") % 10 == 0))

    @cached_property
    def emp(self) -> DataFrame:
        return self["part"].select(
            F.col("p_partkey").alias("emp_id"), F.col("p_name").alias("name"),
            F.struct(F.col("p_brand").alias("city"), F.col("p_type").alias("zip")).alias("address"),
            F.split("p_name", " ").alias("skills"),
            F.create_map(
                F.lit("size"), F.col("p_size"), F.lit("price"), F.col("p_retailprice").cast("int")
            ).alias("scores"),
        )

    @cached_property
    def tree(self) -> DataFrame:
        key = F.col("c_custkey")
        boss = F.when(key == 0, F.lit(-1)).otherwise(F.floor((key - 1) / 4)).cast("bigint")
        return self["customer"].select(key.alias("emp_id"), boss.alias("mgr_id"), F.col("c_name").alias("emp_name"))

    @cached_property
    def sales(self) -> DataFrame:
        line = self["lineitem"].select("l_suppkey", "l_quantity", "l_extendedprice")
        where = self["supplier"].join(self["nation"], F.col("s_nationkey") == F.col("n_nationkey"))
        return line.join(where, F.col("l_suppkey") == F.col("s_suppkey")).select(
            F.col("n_name").alias("region"), F.col("l_quantity").cast("int").alias("units"),
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        )

    @cached_property
    def items(self) -> DataFrame:
        lists = ordered_list(
            self["lineitem"].select("l_orderkey", "l_partkey", "l_quantity"), "l_orderkey", "l_quantity",
            ["l_quantity", "l_partkey"], Split(), LONGEST_LIST,
        )
        return lists.withColumnRenamed("l_orderkey", "id")

    @cached_property
    def logs(self) -> DataFrame:
        level = F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO")
        text = F.concat(
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" "), level,
            F.lit(" user="), F.col("user_id"), F.lit(" action="), F.col("event_type"),
        )
        return self["events"].select("event_id", text.alias("value"))

    @cached_property
    def raw_dates(self) -> DataFrame:
        kind = F.col("o_orderkey") % 4
        text = (
            F.when(kind == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
            .when(kind == 1, F.date_format("o_orderdate", "MM/dd/yyyy"))
            .when(kind == 2, F.date_format("o_orderdate", "yyyy/MM/dd"))
            .otherwise("not-a-date")
        )
        return self["orders"].select(F.col("o_orderkey").alias("id"), text.alias("value"))

    @cached_property
    def names(self) -> DataFrame:
        kind = F.col("p_partkey") % 3
        name = F.col("p_name")
        text = F.when(kind == 0, F.concat(F.lit("  "), name, F.lit(" "))).when(kind == 1, F.upper(name)).otherwise(name)
        return self["part"].select(F.col("p_partkey").alias("id"), text.alias("value"))

    @cached_property
    def nulls(self) -> DataFrame:
        """Customers whose city is missing for every seventh and name for every eleventh."""
        key = F.col("cust_id")
        return self.cust.select(
            "cust_id", F.when(key % 11 != 0, F.col("cust_name")).alias("cust_name"),
            F.when(key % 7 != 0, F.col("city")).alias("city"),
        )

    @cached_property
    def hot(self) -> DataFrame:
        key = F.when(F.col("l_orderkey") % 2 == 0, F.lit(0)).otherwise(F.col("l_partkey")).cast("bigint")
        return self["lineitem"].select(
            key.alias("k"), "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"
        )


SHAPES = {
    "cust": """SELECT c_custkey AS cust_id, c_name AS cust_name, n_name AS city,
        CAST(DATE '2024-01-01' + CAST(c_custkey % 365 AS INTEGER) AS DATE) AS signup_date
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "ord": """SELECT o_orderkey AS order_id, o_custkey AS cust_id, CAST(o_orderdate AS DATE) AS order_date,
        o_totalprice AS amount, CAST(o_totalprice AS DECIMAL(18,2)) AS money,
        CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Pending' ELSE 'Cancelled' END AS status
        FROM orders""",
    "upd": """SELECT event_id AS record_id, user_id AS cust_id, 'Customer_' || user_id AS cust_name,
        event_type AS city, ts AS updated_at,
        CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE' ELSE 'UPDATE' END AS operation
        FROM events""",
    "emp": """SELECT p_partkey AS emp_id, p_name AS name, p_brand AS city, p_type AS zip,
        string_split(p_name, ' ') AS skills, p_size AS size, CAST(trunc(p_retailprice) AS INTEGER) AS price
        FROM part""",
    "tree": """SELECT c_custkey AS emp_id,
        CASE WHEN c_custkey = 0 THEN -1 ELSE CAST(floor((c_custkey - 1) / 4) AS BIGINT) END AS mgr_id,
        c_name AS emp_name FROM customer""",
    "sales": """SELECT n_name AS region, CAST(l_quantity AS INTEGER) AS units, l_extendedprice / l_quantity AS price
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey""",
    "items": f"""SELECT l_orderkey AS id, part, list(l_quantity ORDER BY l_quantity) AS items FROM (
        SELECT l_orderkey, l_quantity, (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity) - 1)
            // {LONGEST_LIST} AS part FROM lineitem) GROUP BY l_orderkey, part""",
    "logs": """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') || ' ' ||
        CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END
        || ' user=' || user_id || ' action=' || event_type AS value FROM events""",
    "raw_dates": """SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS truth, CASE o_orderkey % 4
        WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%m/%d/%Y')
        WHEN 2 THEN strftime(o_orderdate, '%Y/%m/%d') ELSE 'not-a-date' END AS value FROM orders""",
    "names": """SELECT p_partkey AS id, CASE p_partkey % 3 WHEN 0 THEN '  ' || p_name || ' '
        WHEN 1 THEN upper(p_name) ELSE p_name END AS value FROM part""",
    "nulls": """SELECT c_custkey AS cust_id, CASE WHEN c_custkey % 11 <> 0 THEN c_name END AS cust_name,
        CASE WHEN c_custkey % 7 <> 0 THEN n_name END AS city
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "hot": """SELECT CASE WHEN l_orderkey % 2 = 0 THEN 0 ELSE l_partkey END AS k, * FROM lineitem""",
}


def with_shapes(sql: str) -> str:
    """Prefix `sql` with the definitions of the shapes it names as `#shape`."""
    used = [name for name in SHAPES if f"#{name}" in sql]
    for name in sorted(used, key=len, reverse=True):
        sql = sql.replace(f"#{name}", f"s_{name}")
    if not used:
        return sql
    head = ",\n".join(f"s_{name} AS ({SHAPES[name]})" for name in used)
    body = sql.strip()
    for start in ("WITH RECURSIVE ", "WITH "):
        if body.startswith(start):
            return f"{start}{head},\n{body[len(start):]}"
    return f"WITH {head}\n{body}"
