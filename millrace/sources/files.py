"""File sources and sinks. Every writer takes Spark's save `mode`."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import shared_path

CORRUPT = "_corrupt"


def scan(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the tables kept as `<folder>/<name>.parquet`."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def read_json(
    spark: SparkSession, path: str, schema: str | None = None, multiline: bool = False, date_format: str | None = None
) -> DataFrame:
    """JSON lines (or whole-file documents); without a schema, one more pass infers it."""
    reader = spark.read.option("multiLine", multiline)
    if date_format:
        reader = reader.option("dateFormat", date_format)
    return (reader.schema(schema) if schema else reader).json(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str, header: bool = True) -> DataFrame:
    return spark.read.schema(schema).option("header", header).csv(path)


def read_with_rejects(spark: SparkSession, path: str, schema: str, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """Rows of a CSV that fit the schema, and the raw text of those that do not.

    Parsed once into the shared folder: whether a line counts as malformed can
    depend on the columns a query reads, so both results come from one parse.
    """
    parsed = (
        spark.read.schema(f"{schema}, {CORRUPT} string")
        .option("header", header).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )
    landed = shared_path(spark, "parsed")
    parsed.write.parquet(landed)
    kept = spark.read.parquet(landed)
    bad = F.col(CORRUPT).isNotNull()
    return kept.where(~bad).drop(CORRUPT), kept.where(bad).select(F.col(CORRUPT).alias("line"))


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Parquet, optionally partitioned.

    Rows are gathered by partition value before writing, which avoids a file per
    task and value; the rebalance splits a value too large for one task.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def filtered_scan(spark: SparkSession, path: str, predicate: Column, columns: Sequence[str]) -> DataFrame:
    """Filter and projection that both reach the Parquet reader."""
    return spark.read.parquet(path).where(predicate).select(*columns)


def pruned_scan(spark: SparkSession, path: str, partitions: Column) -> DataFrame:
    """Only the folders whose partition values pass are listed and read."""
    return spark.read.parquet(path).where(partitions)


def write_orc(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).orc(path)


def read_orc(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.orc(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines in column `value`."""
    return spark.read.text(path)


def write_sized(df: DataFrame, path: str, rows_per_file: int, mode: str = "overwrite") -> None:
    """Parquet files of at most `rows_per_file` rows.

    Nothing is counted first: adaptive execution evens out the partitions by
    size, and a task starts a new file whenever one is full.
    """
    df.hint("rebalance").write.mode(mode).option("maxRecordsPerFile", rows_per_file).parquet(path)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Size of a folder's data files; reads their metadata, not their content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first()["bytes"]


def compact(spark: SparkSession, source: str, target: str, file_bytes: int = 128 << 20, partitions: Sequence[str] = ()) -> None:
    """Rewrite many small Parquet files as few of about `file_bytes`.

    Without `partitions` there is no shuffle. A table split by columns is named
    them and keeps its folders; its rows are dealt to them by one shuffle, in
    which adaptive execution splits large folders.
    """
    df = spark.read.parquet(source)
    if partitions:
        df.hint("rebalance", *partitions).write.mode("overwrite").partitionBy(*partitions).parquet(target)
        return
    files = max(1, math.ceil(folder_bytes(spark, source) / file_bytes))
    df.coalesce(files).write.mode("overwrite").parquet(target)


def read_merged(spark: SparkSession, path: str, defaults: Mapping[str, Column], schema: str | None = None) -> DataFrame:
    """Parquet files whose columns differ; `defaults` stand for every null of their columns.

    Files whose types differ as well (int and long, say) need the wider `schema`
    of all columns; without one, column sets are merged and types must agree.
    """
    reader = spark.read.schema(schema) if schema else spark.read.option("mergeSchema", True)
    df = reader.parquet(path)
    return df.withColumns({c: F.coalesce(F.col(c), v) for c, v in defaults.items()})


def overwrite_partitions(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Replace the partitions `df` has rows for and leave the others alone.

    `df` must not read `path`.
    """
    writer = df.hint("rebalance", *columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*columns).parquet(path)
