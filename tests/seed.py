"""Small seed tables with known answers."""

from __future__ import annotations

from pyspark.sql import functions as F

# The seed tables whose answers the tests pin.
CUSTOMERS = [(1, "vikram", "hyd", "2024-01-10"), (2, "Rahul", "Bangalore", "2024-02-15"), (3, "Priya", "Chennai", "2024-03-20")]
CITIES = ["hyd", "Bangalore", "Chennai", "Mumbai", "Delhi"]
ORDERS = [
    (101, 1, "2025-01-10", 500.0, "Completed"),
    (102, 2, "2025-01-11", 750.0, "Completed"),
    (103, 1, "2025-01-15", 300.0, "Pending"),
    (104, 5, "2025-02-01", 1200.0, "Completed"),
    (105, 10, "2025-02-10", 450.0, "Cancelled"),
    (106, 500, "2025-02-15", 900.0, "Completed"),
    (107, 700, "2025-03-01", 1500.0, "Completed"),
]
UPDATES = [
    (1, 1, "vikram", "hyd", "2025-01-01 10:00:00", "INSERT"),
    (2, 1, "vikram", "Bangalore", "2025-02-01 10:00:00", "UPDATE"),
    (3, 1, "vikram", "Chennai", "2025-03-01 10:00:00", "UPDATE"),
    (4, 2, "Rahul", "Bangalore", "2025-01-10 10:00:00", "INSERT"),
    (5, 2, "Rahul", "Mumbai", "2025-02-15 10:00:00", "UPDATE"),
    (6, 3, "Priya", "Chennai", "2025-01-05 10:00:00", "INSERT"),
]
REDELIVERED = (7, 3, "Priya", "Hyderabad", "2025-04-01 09:00:00", "UPDATE")
TREE = [(1, -1), (2, 1), (3, 1), (4, 2), (5, 2), (6, 4)]


def customers(spark):
    first = spark.createDataFrame(CUSTOMERS, "cust_id long, cust_name string, city string, signup_date string")
    n = F.col("id")
    city = F.element_at(F.array(*[F.lit(c) for c in CITIES]), (n % 5 + 1).cast("int"))
    rest = spark.range(24, 1001).select(
        n.alias("cust_id"), F.concat(F.lit("Customer_"), n).alias("cust_name"), city.alias("city"),
        F.date_add(F.lit("2024-01-01").cast("date"), (n % 365).cast("int")).alias("signup_date"),
    )
    return first.withColumn("signup_date", F.col("signup_date").cast("date")).unionByName(rest)


def orders(spark):
    df = spark.createDataFrame(ORDERS, "order_id int, cust_id long, order_date string, amount double, status string")
    return df.withColumn("order_date", F.col("order_date").cast("date"))


def updates(spark, more=()):
    df = spark.createDataFrame(
        [*UPDATES, *more], "record_id int, cust_id long, cust_name string, city string, updated_at string, operation string"
    )
    return df.withColumn("updated_at", F.col("updated_at").cast("timestamp_ntz"))


def tree(spark, more=()):
    return spark.createDataFrame([*TREE, *more], "emp_id long, mgr_id long")
