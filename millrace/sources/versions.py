"""Tables whose changes appear all at once.

A table is a folder of immutable part folders and of numbered manifests; a
manifest lists the folders that make up one version. A change writes new part
folders aside and then one manifest, whose name it claims by a rename that
refuses an existing target. That rename is the only step readers can see: a job
that dies before it has changed nothing, and of two jobs that claim one number
only the first succeeds. Readers are pinned to the version they opened.

Rows are grouped by the table's own label: the values of its columns, or a part
number from a key's hash. Manifests have one entry per label, so labels should
number thousands, not millions.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

LABEL = "_label"
TRIES = 20


class StaleVersion(RuntimeError):
    """Someone else changed the same part since the version this change started from."""


@dataclass(frozen=True)
class Manifest:
    number: int
    schema: str
    columns: list[str] = field(default_factory=list)
    parts: int = 0
    folders: dict[str, str] = field(default_factory=dict)
    # The last batch that each stream has applied.
    tokens: dict[str, int] = field(default_factory=dict)


def _plain(column: Column) -> Column:
    """A value as a folder name that needs no escaping; null differs from every text."""
    text = column.cast("string")
    safe = F.when(text.rlike(r"^[A-Za-z0-9._-]+$"), F.concat(F.lit("v."), text)).otherwise(F.concat(F.lit("x."), F.hex(F.encode(text, "UTF-8"))))
    return F.coalesce(safe, F.lit("n"))


def label_of(layout: Manifest) -> Column:
    if layout.parts:
        return F.pmod(F.xxhash64(*layout.columns), F.lit(layout.parts)).cast("string")
    return F.concat_ws("~", *[_plain(F.col(c)) for c in layout.columns])


class _Files:
    """The few file operations that Spark's writers don't offer, on any of Hadoop's file systems."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.gateway = spark._jvm, spark.sparkContext._gateway
        self.conf = spark._jsparkSession.sessionState().newHadoopConf()

    def at(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def of(self, path: str):
        return self.at(path).getFileSystem(self.conf)

    def names(self, path: str) -> list[str]:
        fs = self.of(path)
        return [s.getPath().getName() for s in fs.listStatus(self.at(path))] if fs.exists(self.at(path)) else []

    def text(self, path: str) -> str:
        stream = self.of(path).open(self.at(path))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        stream = self.of(path).create(self.at(path), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def claim(self, source: str, target: str) -> bool:
        """Rename unless the target exists."""
        options = self.gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = self.jvm.org.apache.hadoop.fs.Options.Rename.NONE
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.of(source).getUri(), self.conf)
        try:
            context.rename(self.at(source), self.at(target), options)
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
                self.delete(source)
                return False
            raise
        return True

    def delete(self, path: str) -> None:
        self.of(path).delete(self.at(path), True)


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self._files = spark, path.rstrip("/"), _Files(spark)

    @staticmethod
    def create(df: DataFrame, path: str, columns: Sequence[str], parts: int = 0) -> VersionedTable:
        """Version 1 from `df`, split by the values of `columns`, or into `parts` by their hash."""
        table = VersionedTable(df.sparkSession, path)
        layout = Manifest(0, df.schema.json(), list(columns), parts)
        if table.numbers() or not table._publish(replace(layout, number=1, folders=table._stored(df, layout))):
            raise FileExistsError(f"there is a table at {path}")
        return table

    def numbers(self) -> list[int]:
        """The versions that can be read, oldest first."""
        return sorted(int(n.removesuffix(".json")) for n in self._files.names(f"{self.path}/versions") if n.endswith(".json"))

    def manifest(self, number: int | None = None) -> Manifest:
        if number is None:
            number = max(self.numbers(), default=0)
        if not number:
            raise FileNotFoundError(f"no table at {self.path}")
        return Manifest(**json.loads(self._files.text(self._name(number))))

    def read(self, version: Manifest | int | None = None, labels: Iterable[str] | None = None) -> DataFrame:
        """One version, by default the present one; later changes don't show in the result."""
        at = version if isinstance(version, Manifest) else self.manifest(version)
        wanted = at.folders if labels is None else [name for name in labels if name in at.folders]
        schema = StructType.fromJson(json.loads(at.schema))
        folders = [f"{self.path}/{at.folders[name]}" for name in wanted]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def labels(self, df: DataFrame, at: Manifest) -> list[str]:
        """The labels that `df` has rows for; at most as many as the table has parts or values."""
        return [r[0] for r in df.select(label_of(at)).distinct().collect()]

    def replace(self, df: DataFrame, gone: Iterable[str] = (), base: Manifest | None = None, token: tuple[str, int] | None = None) -> int:
        """A version in which `df` has taken the place of the labels it has rows for; those in `gone` lose theirs in any case.

        `df` may read the table itself. `base` is the version it was computed
        from: if one of its labels has changed since, StaleVersion is raised,
        while changes of other labels are kept. A `token` (stream, batch) that
        the table has seen already changes nothing. Returns the version's number.
        """
        base = base or self.manifest()
        if token and base.tokens.get(token[0], -1) >= token[1]:
            return base.number
        schema = StructType.fromJson(json.loads(base.schema))
        if {f.name: f.dataType for f in df.schema} != {f.name: f.dataType for f in schema}:
            raise ValueError("the rows don't have the table's columns")
        new = self._stored(df.select(*schema.names), base)
        touched = {*gone, *new}
        for _ in range(TRIES):
            now = self.manifest()
            if token and now.tokens.get(token[0], -1) >= token[1]:
                return now.number
            if any(now.folders.get(name) != base.folders.get(name) for name in touched):
                raise StaleVersion(f"version {now.number} has changed a part that version {base.number} was read for")
            folders = {name: folder for name, folder in now.folders.items() if name not in touched} | new
            tokens = now.tokens | ({token[0]: token[1]} if token else {})
            if self._publish(replace(now, number=now.number + 1, folders=folders, tokens=tokens)):
                return now.number + 1
        raise StaleVersion("too many other changes at the same time")

    def forget(self, keep: int = 1) -> None:
        """Remove all but the last `keep` versions, and the folders that only they, or jobs that died, have written.

        Not while another job changes the table: its folders are in no version yet.
        """
        numbers = self.numbers()
        kept = {folder for n in numbers[-keep:] for folder in self.manifest(n).folders.values()}
        for n in numbers[:-keep]:
            self._files.delete(self._name(n))
        for load in self._files.names(f"{self.path}/data"):
            held = [f for f in kept if f.startswith(f"data/{load}/")]
            if not held:
                self._files.delete(f"{self.path}/data/{load}")
                continue
            for name in self._files.names(f"{self.path}/data/{load}"):
                if name.startswith(LABEL) and f"data/{load}/{name}" not in held:
                    self._files.delete(f"{self.path}/data/{load}/{name}")

    def _name(self, number: int) -> str:
        return f"{self.path}/versions/{number:020d}.json"

    def _stored(self, df: DataFrame, layout: Manifest) -> dict[str, str]:
        """Write rows into folders of their own: label to folder."""
        load = f"data/{uuid.uuid4().hex}"
        df.withColumn(LABEL, label_of(layout)).hint("rebalance", LABEL).write.partitionBy(LABEL).parquet(f"{self.path}/{load}")
        names = [n for n in self._files.names(f"{self.path}/{load}") if n.startswith(f"{LABEL}=")]
        return {n.removeprefix(f"{LABEL}="): f"{load}/{n}" for n in names}

    def _publish(self, manifest: Manifest) -> bool:
        aside = f"{self.path}/versions/_{uuid.uuid4().hex}"
        self._files.write(aside, json.dumps(asdict(manifest)))
        return self._files.claim(aside, self._name(manifest.number))
