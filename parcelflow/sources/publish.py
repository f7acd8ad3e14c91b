"""Versions of a set of tables, switched all at once by one manifest.

Below a root, every run writes its tables into a folder of its own,

    ROOT/versions/<version>/<table path>
    ROOT/manifests/<number>.json

and becomes visible by one manifest file that names each table's folder.  A manifest is
written beside its place and renamed to the next free number, so it appears whole or not
at all, and no file that readers use is ever replaced or removed by a run: killed at any
step, it leaves the tables of the last manifest as they were.  Readers take the manifest
with the highest number once and read all tables by it.

Two runs that publish at the same time cannot both take a number: the later one fails
and leaves the earlier one's tables.  Old versions go by :meth:`expire`, never by a run
that writes.  Plain Parquet and Hadoop file calls only: no table format, no catalog.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


class PublishError(RuntimeError):
    pass


@dataclass(frozen=True)
class Manifest:
    """What one run published: the folder (below the root) and schema of each table."""
    number: int = 0
    version: str = ""
    folders: dict[str, str] = field(default_factory=dict)
    schemas: dict[str, dict] = field(default_factory=dict)


class Published:
    """The versions below one root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _numbers(self) -> list[int]:
        folder = self._path(f"{self.root}/manifests")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _read_text(self, path: str) -> str:
        # a manifest is a small file: names and schemas of the tables
        stream = self._fs.open(self._path(path))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _write_text(self, path: str, text: str) -> None:
        stream = self._fs.create(self._path(path), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def manifest(self, number: int | None = None) -> Manifest:
        """The manifest in force (or that of ``number``); an empty one before the first."""
        if number is None:
            number = max(self._numbers(), default=0)
        if not number:
            return Manifest()
        return Manifest(number, **json.loads(self._read_text(self._manifest(number))))

    def _manifest(self, number: int) -> str:
        return f"{self.root}/manifests/{number:08d}.json"

    def draft(self) -> Draft:
        return Draft(self)

    def read(self, name: str, manifest: Manifest | None = None) -> DataFrame:
        """A table by ``manifest`` (the one in force when not given)."""
        manifest = self.manifest() if manifest is None else manifest
        if name not in manifest.folders:
            raise PublishError(f"{self.root} has no published table {name}")
        schema = StructType.fromJson(manifest.schemas[name])
        return (self.spark.read.schema(schema).parquet(f"{self.root}/{manifest.folders[name]}")
                .select(*schema.fieldNames()))

    def expire(self, keep: int = 2, least_age_hours: float = 24.0) -> list[str]:
        """Remove versions that none of the last ``keep`` manifests names and that are
        older than ``least_age_hours`` (a run that still writes is younger); returns them."""
        numbers = self._numbers()
        used = {folder.split("/")[1] for n in numbers[-keep:]
                for folder in self.manifest(n).folders.values()}
        folder = self._path(f"{self.root}/versions")
        if not self._fs.exists(folder):
            return []
        now = self.spark._jvm.java.lang.System.currentTimeMillis()
        old = [s.getPath() for s in self._fs.listStatus(folder)
               if s.getPath().getName() not in used
               and now - s.getModificationTime() >= least_age_hours * 3_600_000]
        for n in numbers[:-keep]:  # readers that hold an old manifest are older than the keep
            self._fs.delete(self._path(self._manifest(n)), False)
        for path in old:
            self._fs.delete(path, True)
        return sorted(p.getName() for p in old)


class Draft:
    """One run's tables, invisible until :meth:`publish`."""

    def __init__(self, published: Published):
        self.published, self.before = published, published.manifest()
        self.version = uuid.uuid4().hex
        self.folders: dict[str, str] = {}
        self.schemas: dict[str, dict] = {}

    def path(self, name: str, place: str | None = None) -> str:
        """The folder of ``name`` in this version; ``place`` is its path in there."""
        return f"{self.published.root}/versions/{self.version}/{place or name}"

    def add(self, name: str, df: DataFrame, place: str | None = None) -> None:
        """A table that has been written to :meth:`path` with the schema of ``df``."""
        self.folders[name] = f"versions/{self.version}/{place or name}"
        self.schemas[name] = json.loads(df.schema.json())

    def publish(self, carry: bool = False) -> Manifest:
        """Switch to this run's tables; with ``carry``, tables it did not write stay as
        the manifest before has them."""
        p = self.published
        folders = (self.before.folders if carry else {}) | self.folders
        schemas = (self.before.schemas if carry else {}) | self.schemas
        number = self.before.number + 1
        target = p._manifest(number)
        fresh = f"{p.root}/manifests/{self.version}.new"
        p._write_text(fresh, json.dumps({"version": self.version, "folders": folders,
                                         "schemas": schemas}))
        if p._fs.exists(p._path(target)) or not p._fs.rename(p._path(fresh), p._path(target)):
            p._fs.delete(p._path(fresh), False)
            raise PublishError(f"another run published below {p.root}; its tables stay")
        return p.manifest(number)
