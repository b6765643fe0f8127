"""Stage tables: intermediate results written once to shared storage.

A plan that reads a result several times, or that needs row numbers to stay
the same between two jobs, writes it here as Parquet. A lost executor then
costs a re-read, never a recomputation with another outcome.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


#: Stage tables are written once and read a few times, so small files are worth their time.
COMPRESSION = "zstd"

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_CLEANING: Counter[int] = Counter()
_CLEANUP_BEFORE: dict[int, str] = {}
_CLEANING_LOCK = Lock()


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that begin inside remove their shuffle files when they end, not when the driver next collects its garbage.

    For writes, whose rows nothing asks the same plan for again. Writes of
    several threads may be open at once; the last one restores the setting.
    """
    key = id(spark)
    with _CLEANING_LOCK:
        _CLEANING[key] += 1
        if _CLEANING[key] == 1:
            _CLEANUP_BEFORE[key] = spark.conf.get(_CLEANUP, "false")
            spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        with _CLEANING_LOCK:
            _CLEANING[key] -= 1
            if not _CLEANING[key]:
                spark.conf.set(_CLEANUP, _CLEANUP_BEFORE.pop(key))


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where that is unset, a subfolder of the warehouse, which is shared too."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return configured.rstrip("/") if configured else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_stages"


class StageStore:
    """Writes and reads the stage tables of one run, in a folder of its own."""

    def __init__(self, spark: SparkSession, folder: str | None = None, compression: str | None = COMPRESSION):
        """Without ``compression`` the session's own is used."""
        self.spark, self.compression = spark, compression
        self.folder = f"{folder or shared_folder(spark)}/clinloom-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` once and return the written table."""
        path = self.path(f"{name}-{uuid.uuid4().hex[:8]}")
        with shuffles_removed(self.spark):
            df.write.parquet(path, compression=self.compression)
        return self.spark.read.schema(df.schema).parquet(path)

    def save_counted(self, df: DataFrame, name: str) -> tuple[DataFrame, int]:
        """``save``, and the number of rows, counted while they are written."""
        counted = Observation()
        table = self.save(df.observe(counted, F.count(F.lit(1)).alias("rows")), name)
        return table, counted.get["rows"]

    def remove(self, name: str) -> None:
        """Remove the tables of that name, when nothing reads them any more."""
        for path in list_files(self.spark, self.folder, f"{name}-*"):
            delete_path(self.spark, path)

    def drop(self) -> None:
        """Remove this run's folder."""
        if self.spark.sparkContext._jsc is None or self.spark.sparkContext._jsc.sc().isStopped():
            return  # out of reach; whoever owns the shared folder clears it
        delete_path(self.spark, self.folder)


def _hadoop(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def list_files(spark: SparkSession, folder: str, pattern: str) -> list[str]:
    target, files = _hadoop(spark, f"{folder}/{pattern}")
    return [found.getPath().toString() for found in files.globStatus(target) or []]


def rename_path(spark: SparkSession, source: str, target: str) -> None:
    path, files = _hadoop(spark, source)
    files.mkdirs(_hadoop(spark, target)[0].getParent())
    if not files.rename(path, _hadoop(spark, target)[0]):
        raise OSError(f"{source} could not be moved to {target}.")


def delete_path(spark: SparkSession, path: str) -> None:
    target, files = _hadoop(spark, path)
    files.delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    target, files = _hadoop(spark, path)
    return files.exists(target)


def walk_files(spark: SparkSession, folder: str) -> list[str]:
    """All files below a folder, but those of hidden names."""
    target, files = _hadoop(spark, folder)
    found, rest = [], files.listFiles(target, True)
    while rest.hasNext():
        path = rest.next().getPath().toString()
        if not any(part[:1] in "._" for part in path.removeprefix(target.toString()).rstrip("/").split("/")[1:]):
            found.append(path)
    return found


def write_text(spark: SparkSession, path: str, text: str) -> None:
    target, files = _hadoop(spark, path)
    out = files.create(target, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    target, files = _hadoop(spark, path)
    source = files.open(target)
    try:
        return bytes(source.readAllBytes()).decode("utf-8")
    finally:
        source.close()
