"""Generated frames and catalog tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import shared_path


def number_range(spark: SparkSession, low: int, high: int) -> DataFrame:
    """Integers from `low` up to but not including `high`, in column `id`."""
    return spark.range(low, high)


def inline_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small literal table."""
    return spark.createDataFrame(list(rows), schema)


def write_bucketed(
    df: DataFrame, table: str, buckets: int, bucket_by: Sequence[str], sort_by: Sequence[str] = ()
) -> None:
    """Catalog table whose files are split by key, in the shared folder.

    Joins and groupings on the bucket columns then need no shuffle. The rows are
    repartitioned to the buckets first, so each bucket is one file.
    """
    writer = df.repartition(buckets, *bucket_by).write.mode("overwrite").format("parquet")
    writer = writer.bucketBy(buckets, *bucket_by).sortBy(*(sort_by or bucket_by))
    writer.option("path", shared_path(df.sparkSession, table)).saveAsTable(table)


def bucketed_join(spark: SparkSession, left: str, right: str, on: str) -> DataFrame:
    """Join two tables bucketed alike on `on`; nothing is shuffled or broadcast."""
    return spark.table(left).hint("merge").join(spark.table(right), on)


def ctas(spark: SparkSession, table: str, df: DataFrame) -> DataFrame:
    """Create a table from a query and read it."""
    df.write.mode("overwrite").format("parquet").option("path", shared_path(spark, table)).saveAsTable(table)
    return spark.table(table)


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def catalog_profile(spark: SparkSession) -> DataFrame:
    """Database, table and column names with types, for all tables and views."""
    database = spark.catalog.currentDatabase()
    parts = []
    for table in spark.catalog.listTables():
        columns = spark.sql(f"DESCRIBE TABLE {table.name}").where("col_name NOT LIKE '#%' AND col_name <> ''")
        parts.append(
            columns.select(
                F.lit(database).alias("database"), F.lit(table.name).alias("table"),
                F.col("col_name").alias("column"), F.col("data_type").alias("type"),
            )
        )
    if not parts:
        return spark.createDataFrame([], "database string, table string, column string, type string")
    everything = parts[0]
    for part in parts[1:]:
        everything = everything.unionByName(part)
    return everything
