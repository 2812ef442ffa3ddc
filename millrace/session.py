"""Session settings and the shared folder jobs write their intermediate tables to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution picks partition counts, splits skewed join partitions and
# turns joins into broadcasts from measured sizes; the rest of the library
# relies on it instead of fixed partition numbers.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Early limits per key up to this n, and the progress of that many micro-batches.
    "spark.sql.optimizer.windowGroupLimitThreshold": "100000",
    "spark.sql.streaming.numRecentProgressUpdates": "10000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def sizing(data_bytes: int) -> dict[str, str]:
    """Partition settings for jobs that read about `data_bytes`.

    Shuffles start with a partition per GiB read, since most operators shrink
    rows first, and adaptive execution merges those that turn out small. Above
    10 TiB, larger splits keep the number of map tasks in the low hundred
    thousands.
    """
    start = min(max(data_bytes >> 30, 200), 100_000)
    split = 512 << 20 if data_bytes > 10 << 40 else 128 << 20
    return {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(start),
        "spark.sql.files.maxPartitionBytes": str(split),
    }


def build_session(
    name: str = "millrace",
    master: str | None = None,
    settings: dict[str, str] | None = None,
    data_bytes: int | None = None,
) -> SparkSession:
    """A session with the library's settings, sized for `data_bytes` if given, and
    overridden by `settings`."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    sized = sizing(data_bytes) if data_bytes else {}
    for key, value in (SETTINGS | sized | (settings or {})).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`, visible to every executor.

    Only a local-mode session without the setting gets a folder of its own; on
    a cluster a machine-local folder would lose data with its machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not root:
        current = context.getCheckpointDir()
        if current:
            return current
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="run-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def shared_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame) -> DataFrame:
    """The same rows, computed now and kept in the shared folder.

    For results that several plans read, and for loops whose plans would grow.
    The copy outlives lost executors.
    """
    shared_root(df.sparkSession)
    return df.checkpoint()


def laid_out(df: DataFrame) -> DataFrame:
    """As `stored`, for a plan that ends in a partitioning and sort: later plans know
    of both and need no shuffle or sort for them. Adaptive plans hide them, so this
    one is not adaptive; store a costly input first."""
    spark = df.sparkSession
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        # Planned anew, as a plan once made keeps its kind.
        return stored(df.select("*"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
