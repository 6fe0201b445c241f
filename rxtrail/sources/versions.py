"""Versions of a stored folder, and of an output that is kept by month.

A store is a folder. A version writes what it changes into a folder of its own below ``data``
and then says, in one small file below ``manifest``, which folders it consists of. That file
appears by a rename, last of all, so a version is there whole or not at all: a run that dies
before leaves the previous version current, and readers of it are not disturbed. Of two runs that
start from one version the later one fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Collection

from pyspark.sql import DataFrame, SparkSession

from rxtrail.sources.relations import RELATIONS

MONTH = "event_month"


class Versions:
    """A folder whose versions are told by small files of JSON."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop
        self._files = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._hadoop.fs.Path(f"{self.folder}/{name}")

    def _names(self, name: str) -> list[str]:
        """What a folder holds, no hidden files."""
        path = self._path(name)
        found = self._files.listStatus(path) if self._files.exists(path) else []
        return [n for n in (status.getPath().getName() for status in found) if n[0] not in "._"]

    def versions(self) -> list[int]:
        return sorted(int(name) for name in self._names("manifest"))

    def current(self) -> int:
        """The newest version, 0 if there is none."""
        return max(self.versions(), default=0)

    def content(self, version: int | None = None) -> dict:
        """What a version, by default the current one, says of itself; nothing if there is none."""
        version = self.current() if version is None else version
        if not version:
            return {}
        lines = self.spark.read.text(f"{self.folder}/manifest/{version:08d}", wholetext=True)
        return json.loads(lines.first().value)

    def new_folder(self, version: int) -> str:
        """A name below the store's folder that no other run writes to."""
        return f"data/{version:08d}-{uuid.uuid4().hex}"

    def name_version(self, version: int, content: dict) -> None:
        """Make a version current; raises if another run has made it."""
        draft, final = self._path(f"manifest/_{uuid.uuid4().hex}"), self._path(f"manifest/{version:08d}")
        stream = self._files.create(draft, False)
        try:
            stream.write(bytearray(json.dumps(content, indent=0, sort_keys=True), "utf-8"))
        finally:
            stream.close()
        if self._files.exists(final) or not self._files.rename(draft, final):
            self._files.delete(draft, False)
            raise RuntimeError(f"version {version} of {self.folder} was made by another run")

    def folders(self, version: int) -> set[str]:
        """The folders below ``data`` that a version consists of."""
        raise NotImplementedError

    def remove_older(self, keep: int = 2) -> None:
        """Forget all but the newest versions, and delete what none of those needs.

        Folders of versions to come are left alone, as a run may be writing one.
        """
        versions = self.versions()
        needed = set().union(*[self.folders(v) for v in versions[-keep:]])
        for version in versions[:-keep]:
            self._files.delete(self._path(f"manifest/{version:08d}"), False)
        for name in self._names("data"):
            if name not in needed and int(name.partition("-")[0]) <= versions[-1]:
                self._files.delete(self._path(f"data/{name}"), True)


class MonthlyVersions(Versions):
    """A store of one relation's rows by month of event."""

    def __init__(self, spark: SparkSession, folder: str, relation: str = "chronic_purchases"):
        super().__init__(spark, folder)
        self.relation = relation

    def months(self, version: int | None = None) -> dict[str, str]:
        """Of a version, by default the current one, the folder of every month."""
        return self.content(version)

    def read(self, version: int | None = None, only: Collection[str] | None = None) -> DataFrame:
        """The rows of a version, by default the current one, or of some months of it."""
        schema = RELATIONS[self.relation]
        folders = [f for month, f in sorted(self.months(version).items()) if only is None or month in only]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.folder}/{f}" for f in folders])

    def publish(self, write: Callable[[str], None], touched: Collection[str] | None, base: int) -> int:
        """Make a new version of ``base``: ``write`` fills a folder with the touched months.

        Other months stay those of ``base``; touched ones of which nothing was written are no
        longer there. None for ``touched`` means all months. Nothing touched makes no version.
        """
        if touched is not None and not touched:
            return base
        version = base + 1
        new = self.new_folder(version)
        write(f"{self.folder}/{new}")
        kept = {} if touched is None else {m: f for m, f in self.months(base).items() if m not in touched}
        written = {name.partition("=")[2]: f"{new}/{name}" for name in self._names(new)}
        self._name_months(version, kept | written)
        return version

    def _name_months(self, version: int, months: dict[str, str]) -> None:
        self.name_version(version, months)

    def folders(self, version: int) -> set[str]:
        return {folder.split("/")[1] for folder in self.months(version).values()}
