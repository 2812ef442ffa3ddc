"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import shared_path

# White space between words: blank, tab, line feed, vertical tab, form feed, return.
BLANKS = r"[\x20\x09-\x0D]+"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with `value` computed once, inside one expression."""
    return F.transform(F.array(value), use)[0]


# Most rows of a batch handed to Python: whole texts are long, so the default of 10,000 is too many.
BATCH_ROWS = 1_000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def mapped(use: Callable, values: pa.Array, kind: pa.DataType) -> pa.Array:
    """`use` of each value, listing a small batch of them at a time: a function on columns gets batches of the session's size."""
    parts = [values.slice(k, BATCH_ROWS) for k in range(0, len(values), BATCH_ROWS)]
    return pa.concat_arrays([pa.array([], kind), *[pa.array([use(v) for v in part.to_pylist()], kind) for part in parts]])


class Scope:
    """The tables that `written` makes inside `with scope:`, which `drop` removes."""

    def __init__(self):
        self.paths: list[str] = []

    def __enter__(self) -> Scope:
        _SCOPES.append(self)
        return self

    def __exit__(self, *error: object) -> None:
        _SCOPES.remove(self)

    def drop(self, spark: SparkSession) -> None:
        """Remove the tables; whatever was computed from them has to be stored by now."""
        conf = spark._jsparkSession.sessionState().newHadoopConf()
        for path in self.paths:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(conf).delete(place, True)
        self.paths.clear()


_SCOPES: list[Scope] = []


def written(df: DataFrame, label: str, codec: str = "zstd") -> DataFrame:
    """The same rows, computed now, in small batches where Python does it, and read back from Parquet in the shared folder."""
    spark = df.sparkSession
    path = shared_path(spark, label)
    before = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, min(int(before), BATCH_ROWS) if int(before) > 0 else BATCH_ROWS)
    try:
        df.write.option("compression", codec).parquet(path)
    finally:
        spark.conf.set(_BATCH, before)
    if _SCOPES:
        _SCOPES[-1].paths.append(path)
    return spark.read.schema(df.schema).parquet(path)
