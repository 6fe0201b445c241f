"""Intermediate tables in a folder that the whole cluster shares.

A stage read by several later steps is written once as Parquet: later steps read only the
columns they need, and an executor lost afterwards costs nothing but its own tasks.

A run that has a key can be taken up again after its driver was lost: the folder is named by the
key, and stages that are there whole are read instead of made. The key is a hash of all that the
stages follow from, so a run on other inputs or with other settings never meets them.
"""

from __future__ import annotations

import hashlib
import time
import uuid
from types import TracebackType

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The shared folder that the session names."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise ValueError("name a folder that all executors can reach in spark.checkpoint.dir")
    return root


def run_key(*inputs: DataFrame, settings: object) -> str:
    """A hash of the inputs' plans and files, with sizes and times, and of the settings.

    ``settings`` tell themselves apart by their ``repr``; a day that follows the calendar has to be
    named there, as the key can't know when a stage was made.
    """
    parts = [repr(settings)]
    for frame in inputs:
        parts.append(frame._jdf.queryExecution().analyzed().canonicalized().toString())
        spark = frame.sparkSession
        for name in sorted(frame.inputFiles()):
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
            status = _files_of(spark, path).getFileStatus(path)
            parts.append(f"{name} {status.getLen()} {status.getModificationTime()}")
    return hashlib.sha256("\0".join(parts).encode()).hexdigest()[:32]


def _files_of(spark: SparkSession, path):
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove_abandoned(spark: SparkSession, hours: float, root: str | None = None) -> list[str]:
    """Delete the folders of runs that have not written a stage for so long; returns their names.

    That time is their lease: give it more hours than any stage takes.
    """
    top = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root or shared_folder(spark))
    files, removed = _files_of(spark, top), []
    for folder in files.listStatus(top) if files.exists(top) else []:
        if not folder.getPath().getName().startswith(PREFIX):
            continue
        stages = [s.getModificationTime() for s in files.listStatus(folder.getPath())]
        if max([folder.getModificationTime(), *stages]) < (time.time() - hours * 3600) * 1000:
            files.delete(folder.getPath(), True)
            removed.append(folder.getPath().getName())
    return removed


PREFIX = "rxtrail-"


class Staging:
    """Writes the intermediate tables of one run under a folder of its own.

    Frames built on them are lazy, so the folder must outlive them: a caller that has written
    its result calls ``remove``, or uses the object as a context manager around the write. With
    a ``key`` an error leaves the folder to the next run of that key; without one it goes too.
    """

    def __init__(self, spark: SparkSession, root: str | None = None, key: str | None = None):
        self._spark = spark
        self.key = key
        self.folder = f"{(root or shared_folder(spark)).rstrip('/')}/{PREFIX}{key or uuid.uuid4().hex}"
        self._written = 0

    def __enter__(self) -> Staging:
        return self

    def __exit__(
        self, kind: type[BaseException] | None, error: BaseException | None, trace: TracebackType | None
    ) -> None:
        if error is None or self.key is None:
            self.remove()

    def write(self, frame: DataFrame, name: str) -> DataFrame:
        """Store ``frame`` and return a reader of the stored copy."""
        return self._spark.read.schema(frame.schema).parquet(self.store(frame, name))

    def store(self, frame: DataFrame, name: str) -> str:
        """Store ``frame`` and return where."""
        path = self.new_path(name)
        if self.key is None:
            frame.write.parquet(path)
        elif not self._is_whole(path):
            # What a lost driver left behind is not whole without its mark.
            frame.write.mode("overwrite").parquet(path)
        return path

    def _is_whole(self, path: str) -> bool:
        mark = self._spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        return _files_of(self._spark, mark).exists(mark)

    def new_path(self, name: str) -> str:
        """A path in this run's folder that nothing else uses."""
        self._written += 1
        return f"{self.folder}/{self._written:02d}-{name}"

    def remove(self) -> None:
        """Delete what this run has stored."""
        jvm = self._spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.folder)
        _files_of(self._spark, path).delete(path, True)
