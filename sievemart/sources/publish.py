"""Results that appear whole, and a manifest from which a stopped job goes on."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "_manifest"
STAGING = "_staging"
MANIFEST_SCHEMA = "step string, made_from string, published_at timestamp"


def input_state(spark: SparkSession, path: str) -> str:
    """Files behind a path or pattern: how many, their bytes and the latest change."""
    found, pending = [], [_path(spark, path)]
    while pending:
        at = pending.pop()
        for status in _files(spark, at).globStatus(at) or []:
            if status.isDirectory():
                pending.append(_path(spark, f"{status.getPath()}/*"))
            else:
                found.append((status.getLen(), status.getModificationTime()))
    return f"{path}: {len(found)} files, {sum(n for n, _ in found)} bytes, {max((t for _, t in found), default=0)}"


def _path(spark: SparkSession, name: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)


def _files(spark: SparkSession, path):
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


class Publisher:
    """Publishes the steps of a job into one folder.

    A step is written into a staging folder, renamed to its place and then recorded,
    so a reader finds a whole result or none, and a job stopped at any moment leaves
    no record of a step that is not there.  Where the store's rename is a copy, the
    record alone tells that a result is whole.

    With ``resume`` a step is skipped if it was recorded with the same ``made_from``,
    which should name the job's input and parameters, and no step before it was made
    anew.
    """

    def __init__(self, spark: SparkSession, folder: str, made_from: str = "", resume: bool = False) -> None:
        self.spark, self.folder, self.made_from = spark, folder, made_from
        self.made: list[str] = []
        latest = F.max_by("made_from", "published_at").alias("made_from")
        known = self.manifest().groupBy("step").agg(latest).filter(F.col("made_from") == made_from)
        # One row per step of the job's code.
        self._done = {row["step"] for row in known.collect()} if resume else set()

    def _exists(self, name: str) -> bool:
        at = _path(self.spark, f"{self.folder}/{name}")
        return _files(self.spark, at).exists(at)

    def manifest(self) -> DataFrame:
        """Every publication so far: step, what it was made from, and when."""
        if not self._exists(MANIFEST):
            return self.spark.createDataFrame([], MANIFEST_SCHEMA)
        # Named file by file: Spark takes folders with a leading underscore as hidden.
        return self.spark.read.schema(MANIFEST_SCHEMA).json(f"{self.folder}/{MANIFEST}/*.json")

    def _record(self, name: str) -> None:
        row = self.spark.range(1).select(
            F.lit(name).alias("step"), F.lit(self.made_from).alias("made_from"), F.current_timestamp().alias("published_at")
        )
        row.write.mode("append").json(f"{self.folder}/{MANIFEST}")
        self.made.append(name)

    def publish(self, name: str, write: Callable[[str], None]) -> str:
        """Where the step's result is; ``write`` makes it at the path that it is given."""
        target = f"{self.folder}/{name}"
        if not self.made and name in self._done and self._exists(name):
            return target
        aside, place = (_path(self.spark, x) for x in (f"{self.folder}/{STAGING}/{name}", target))
        store = _files(self.spark, place)
        store.delete(aside, True)
        write(f"{self.folder}/{STAGING}/{name}")
        store.delete(place, True)
        store.mkdirs(place.getParent())
        if not store.rename(aside, place):
            raise OSError(f"cannot rename {aside} to {place}")
        self._record(name)
        return target

    def once(self, name: str, action: Callable[[], None]) -> None:
        """A step whose result is elsewhere, as in the catalog."""
        if self.made or name not in self._done:
            action()
            self._record(name)
