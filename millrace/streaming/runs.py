"""Running streams to a stop, into files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.joins import latest_row
from millrace.sources.versions import VersionedTable


def run_to_files(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process what has arrived since the last run and stop.

    Offsets and finished files are both logged, so after a crash or restart with
    the same checkpoint every row is in the output once.
    """
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    query = writer.trigger(availableNow=True).start(path)
    query.awaitTermination()
    return query


def _run_of(spark: SparkSession, path: str, checkpoint: str) -> int:
    """Number of this checkpoint's run into a folder; a new checkpoint starts the next run.

    Kept beside the data, under a name that readers of the folder skip. Batch
    numbers count from 0 in every run, so they alone don't tell batches apart.
    """
    listed = f"{path}/_runs"
    try:
        runs = {r["checkpoint"]: r["run"] for r in spark.read.parquet(listed).collect()}
    except AnalysisException:  # the first run
        runs = {}
    if checkpoint not in runs:
        runs[checkpoint] = len(runs)
        spark.createDataFrame([(checkpoint, runs[checkpoint])], "checkpoint string, run int").write.mode("append").parquet(listed)
    return runs[checkpoint]


def run_mode(df: DataFrame, mode: str, path: str, checkpoint: str) -> StreamingQuery:
    """As `run_to_files` for output modes files cannot take (update, complete).

    Each micro-batch replaces its own folder `run=<number>/batch=<id>`, so a
    repeated batch changes nothing, and a replay with a new checkpoint comes
    after what was there.
    """
    run = _run_of(df.sparkSession, path, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/run={run}/batch={batch_id}")

    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def latest_complete(spark: SparkSession, path: str) -> DataFrame:
    """The result a complete-mode run last wrote."""
    written = spark.read.parquet(path)
    place = F.struct("run", "batch")
    last = written.agg(F.max(place).alias("last")).scalar()
    return written.where(place == last).drop("run", "batch")


def latest_updates(spark: SparkSession, path: str, key: str) -> DataFrame:
    """Per key the row an update-mode run last wrote."""
    return latest_row(spark.read.parquet(path), key, ["run", "batch"]).drop("run", "batch")


def stream_upsert(log: DataFrame, target: str, checkpoint: str, key: str, ts: str, seq: str) -> StreamingQuery:
    """Keep a table current from a stream of changes.

    A micro-batch writes its winning row per key, deletions included, to
    `run=<number>/batch=<id>` and costs what the batch holds, not what the table
    does; a replayed batch rewrites the same folder. `upserted` reads the current
    rows, `fold_upserts` makes a table of them.
    """
    run = _run_of(log.sparkSession, target, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        latest_row(batch, key, [ts, seq]).write.mode("overwrite").parquet(f"{target}/run={run}/batch={batch_id}")

    writer = log.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def upserted(spark: SparkSession, target: str, key: str, ts: str, seq: str, op: str | None = None) -> DataFrame:
    """The current row per key of a table `stream_upsert` keeps; keys whose last `op` is DELETE are gone."""
    current = latest_row(spark.read.parquet(target).drop("run", "batch"), key, [ts, seq])
    return current.where(~F.col(op).eqNullSafe("DELETE")) if op else current


def fold_upserts(spark: SparkSession, source: str, target: str, key: str, ts: str, seq: str) -> None:
    """Write one row per key, the winning one, of all batches in `source` as the first batch of `target`.

    `target` then takes the place of `source` for the next batches. Deletions
    stay as rows, so that a late change of a deleted key loses against them.
    """
    latest_row(spark.read.parquet(source).drop("run", "batch"), key, [ts, seq]).write.mode("overwrite").parquet(f"{target}/run=-1/batch=0")


def stream_into_versions(log: DataFrame, path: str, checkpoint: str, key: str, ts: str, seq: str) -> StreamingQuery:
    """Keep a `VersionedTable` split by hash of `key` current from a stream of changes.

    Each micro-batch is one version and rewrites the parts its keys are in, so
    readers never see half a batch and need no merge; a batch that ran before a
    crash is known by its token. Deletions stay as rows, against late changes of
    deleted keys. Batches should be large for their number of parts; where they
    are small, `stream_upsert` writes less.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        table = VersionedTable(batch.sparkSession, path)
        base = table.manifest()
        if base.tokens.get(checkpoint, -1) >= batch_id:
            return
        batch = batch.persist()
        touched = table.labels(batch, base)
        rows = latest_row(table.read(base, touched).unionByName(latest_row(batch, key, [ts, seq])), key, [ts, seq])
        table.replace(rows, touched, base, (checkpoint, batch_id))
        batch.unpersist()

    writer = log.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def state_report(query: StreamingQuery) -> DataFrame:
    """Rows and bytes of state per stateful operator after the last micro-batch
    that reported them."""
    spark = SparkSession.active()
    rows = [
        (p.batchId, i, s.operatorName, s.numRowsTotal, s.numRowsDroppedByWatermark, s.memoryUsedBytes)
        for p in query.recentProgress for i, s in enumerate(p.stateOperators)
    ]
    schema = "batch long, position int, operator string, rows long, dropped_late long, bytes long"
    return spark.createDataFrame(rows, schema)
