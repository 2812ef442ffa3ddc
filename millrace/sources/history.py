"""A history of versions kept up to date batch by batch.

The table is a `VersionedTable` split by key hash: a batch reads and writes the
parts its keys are in, not the history of all keys, and shows whole or not at all.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.changes import splice
from millrace.operators.windows import Split
from millrace.session import stored
from millrace.sources.versions import VersionedTable


@dataclass(frozen=True)
class KeptHistory:
    """Where a history lies and which columns of the change log make it.

    `ts` and `seq` order a key's changes, `tracked` are the columns whose change
    starts a version.
    """

    path: str
    key: str
    ts: str
    seq: str
    tracked: Sequence[str]
    split: Split = Split()

    def create(self, log: DataFrame, parts: int) -> None:
        """An empty history for changes with the columns of `log`."""
        columns = [self.key, self.seq, *[c for c in self.tracked if c not in (self.key, self.ts, self.seq)]]
        time = F.col(self.ts)
        shape = log.select(*columns, time.alias("valid_from"), time.alias("valid_to"), F.lit(True).alias("opens"))
        VersionedTable.create(log.sparkSession.createDataFrame([], shape.schema), self.path, [self.key], parts)

    def add(self, batch: DataFrame, token: tuple[str, int] | None = None) -> int:
        """Splice a batch of changes in; returns the table's version.

        Delivered again, a batch changes nothing in any case; its `token` (feed,
        number) spares the work.
        """
        table = VersionedTable(batch.sparkSession, self.path)
        base = table.manifest()
        if token and base.tokens.get(token[0], -1) >= token[1]:
            return base.number
        batch = stored(batch.select(*dict.fromkeys([self.key, self.ts, self.seq, *self.tracked])))
        parts = table.labels(batch, base)
        spliced = splice(table.read(base, parts), batch, self.key, self.ts, self.seq, self.tracked, self.split)
        return table.replace(spliced, parts, base, token)

    def read(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """The versions, `[valid_from, valid_to)`, with `is_current`."""
        rows = VersionedTable(spark, self.path).read(version).where("opens").drop("opens")
        return rows.withColumn("is_current", F.col("valid_to").isNull())
