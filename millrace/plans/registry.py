"""The table of registered queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.plans.shapes import Tables, with_shapes


@dataclass(frozen=True)
class Registered:
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        return presentable(self.build(Tables(spark, folder)))


QUERIES: dict[str, Registered] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Register a query under its inventory id, with the SQL its answer must equal."""
    def add(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = Registered(build, with_shapes(sql) if sql else None)
        return build

    return add


def presentable(df: DataFrame) -> DataFrame:
    """Dates and times as text and decimals as doubles, which any engine can compare."""
    columns = []
    for field in df.schema:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        elif isinstance(field.dataType, T.DecimalType):
            c = c.cast("double")
        columns.append(c.alias(field.name))
    return df.select(*columns)
