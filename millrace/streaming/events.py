"""Streaming transformations. Each takes and returns a frame, and gives the same
rows in batch, except for windows a stream has not closed yet."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.operators.skew import row_salt


def read_events(spark: SparkSession, path: str, schema, ts: str, files_per_batch: int = 1000) -> DataFrame:
    """Parquet files as a stream, with the event time as an instant, which
    watermarks need."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    return stream.withColumn(ts, F.col(ts).cast("timestamp"))


def with_lateness(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """Rows more than `delay` behind the newest may be dropped by what follows."""
    return df.withWatermark(ts, delay)


def _windowed(df: DataFrame, window: Column, keys: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    counted = df.groupBy(window.alias("w"), *keys).agg(*[c.alias(n) for n, c in aggs.items()])
    return counted.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, *aggs)


def tumbling(df: DataFrame, ts: str, size: str, aggs: Mapping[str, Column], keys: Sequence[str] = ()) -> DataFrame:
    return _windowed(df, F.window(ts, size), keys, aggs)


def sliding(
    df: DataFrame, ts: str, size: str, slide: str, aggs: Mapping[str, Column], keys: Sequence[str] = ()
) -> DataFrame:
    return _windowed(df, F.window(ts, size, slide), keys, aggs)


def sessions(df: DataFrame, key: str, ts: str, gap: str, aggs: Mapping[str, Column]) -> DataFrame:
    """Per key, windows that end after a pause of `gap`."""
    return _windowed(df, F.session_window(ts, gap), [key], aggs)


def stream_dedup(df: DataFrame, key: list[str]) -> DataFrame:
    """First arrival per key; a key is forgotten once the watermark has passed it."""
    return df.dropDuplicatesWithinWatermark(key)


def stream_interval_join(
    a: DataFrame, b: DataFrame, key: str, a_ts: str, b_ts: str, seconds: int
) -> DataFrame:
    """Pairs with the same key and `a_ts <= b_ts <= a_ts + seconds`.

    Both sides need watermarks; those and the time range bound the state. The
    time slot is part of the join key, so a hot key's state is spread out. `b`
    carries the key as `b_<key>`.
    """
    def slot(ts: str) -> Column:
        return F.floor(F.unix_micros(ts) / F.lit(seconds * 1_000_000))

    left = a.withColumn("_a_slot", slot(a_ts))
    right = b.withColumnRenamed(key, f"b_{key}").withColumn("_b_slot", F.explode(F.array(slot(b_ts), slot(b_ts) - 1)))
    pairs = left.join(
        right,
        (F.col(key) == F.col(f"b_{key}")) & (F.col("_a_slot") == F.col("_b_slot"))
        & (F.col(b_ts) >= F.col(a_ts)) & (F.col(b_ts) <= F.col(a_ts) + F.expr(f"INTERVAL {seconds} SECONDS")),
    )
    return pairs.drop("_a_slot", "_b_slot", f"b_{key}")


def enrich(stream: DataFrame, dim: DataFrame, on: str) -> DataFrame:
    """Stream rows with a static table's columns; Spark broadcasts the table if it
    is small enough, and shuffles both otherwise."""
    return stream.join(dim, on)


class _RunningTotals(StatefulProcessor):
    """Count and sum per key from partial ones, given out again whenever they change."""

    def __init__(self, key: str, ttl_ms: int | None):
        self._row, self._ttl = Row(key, "shard", "n", "total"), ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._state = handle.getValueState("totals", "n long, total double", self._ttl)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        n, total = self._state.get() or (0, None)
        for row in rows:
            n += row["n"]
            if row["total"] is not None:
                total = row["total"] + (total or 0.0)
        self._state.update((n, total))
        yield self._row(*key, n, total)

    def close(self) -> None:
        pass


# Rows a task adds up before it passes their partial totals on, and rows of a key among them that make it a hot one.
PARTIAL_ROWS = 1 << 20
HOT_ROWS = 10_000


def _partial_totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Count and sum per key of each stretch of a task's rows (key, shard, value). Keys not hot there have shard 0."""
    def added_up(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held)
        key = rows.column_names[0]
        sums = rows.group_by(key, use_threads=False).aggregate([("shard", "first"), ("value", "count", pc.CountOptions(mode="all")), ("value", "sum")])
        n = sums["value_count"]
        shard = pc.if_else(pc.greater_equal(n, HOT_ROWS), sums["shard_first"], pa.scalar(0, pa.int64()))
        yield from pa.table([sums[key], shard, n, sums["value_sum"]], names=[key, "shard", "n", "total"]).to_batches()

    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += len(batch)
        if n >= PARTIAL_ROWS:
            yield from added_up(held)
            held, n = [], 0
    if n:
        yield from added_up(held)


def running_state(df: DataFrame, key: str, value: str, row_id: str, shards: int = 8, ttl_ms: int | None = None) -> DataFrame:
    """Running count and sum per (key, shard), kept until idle for `ttl_ms`.

    Tasks add up their rows first, so the state is asked once per key and
    micro-batch, and a hot key's rows don't move. A key has one state unless it
    is hot; then its partial totals are spread over `shards`. `combine_shards`
    adds them up. Run it in update mode.
    """
    key_type = dict(df.dtypes)[key]
    sharded = df.select(key, row_salt([row_id], shards).cast("long").alias("shard"), F.col(value).cast("double").alias("value"))
    partial = sharded.mapInArrow(_partial_totals, f"`{key}` {key_type}, shard long, n long, total double")
    return partial.groupBy(key, "shard").transformWithState(
        statefulProcessor=_RunningTotals(key, ttl_ms),
        outputStructType=f"`{key}` {key_type}, shard bigint, n bigint, total double",
        outputMode="update",
        timeMode="processingTime" if ttl_ms else "none",
    )


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Set what `running_state` needs while its query starts and runs.

    Batches without data are off: state that expires by the clock asks for one
    after another, and a run over the available files would never end.
    """
    wanted = {
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def combine_shards(updates: DataFrame, key: str) -> DataFrame:
    """Totals per key from the update each of its shards gave last; `updates` has
    the micro-batch number in `batch`."""
    latest = updates.groupBy(key, "shard").agg(F.max(F.struct("batch", "n", "total")).alias("s"))
    return latest.groupBy(key).agg(F.sum("s.n").alias("n"), F.sum("s.total").alias("total"))
