"""Stored tables that are replaced as a whole: versions, and one manifest swapped last.

A folder holds one table or a set. Every write puts its data in a new sub-folder; only when
all of it is there does a manifest with the next number appear, by a rename that fails
if the number is taken. Readers follow the manifest with the highest number. So a job that
dies in mid-write leaves the last version as it was, several tables change at the same
moment, and a query may read the table that it replaces.

Tables that a write does not name stay as they are. If another writer has committed in
between, the write goes on top of it unless both name a common table: that is an error,
and the later one's data is deleted. `vacuum` deletes data of old versions, and on request
what dead writers have left. A manifest is one small file: its size follows the number of tables.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.session import drop

MANIFESTS, KEPT = "_manifests", 2
TABLE = "table"  # the name of the table in a folder of only one
VALUES_A_FILE = 1_000_000  # distinct lookup keys that a file's Bloom filter is sized for


class Conflict(RuntimeError):
    """Another writer has replaced one of the tables since this write began."""


def write_files(df: DataFrame, path: str, partition_by: str | None = None, sort_by: str | None = None) -> None:
    """The files of one table.

    `sort_by` is the key of most lookups: it orders the rows inside each file, so that row
    groups and pages have narrow ranges, and gets a Bloom filter, so that files and row groups without the
    wanted key are left out.

    A partitioned table is rebalanced by its partition column: adaptive execution
    splits a partition that holds most rows over many tasks of the advisory size
    and joins small ones, so files are neither huge nor many.
    """
    keys = [c for c in (partition_by, sort_by) if c]
    if partition_by:
        df = df.hint("rebalance", F.col(partition_by))
    out = (df.sortWithinPartitions(*keys) if sort_by else df).write
    if sort_by:
        out = out.options(**{f"parquet.bloom.filter.enabled#{sort_by}": "true",
                             f"parquet.bloom.filter.expected.ndv#{sort_by}": str(VALUES_A_FILE),
                             "parquet.bloom.filter.adaptive.enabled": "true"})
    if partition_by:
        out = out.partitionBy(partition_by)
    out.parquet(path)


class Snapshots:
    """The versions of the tables below a folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        jvm = spark._jvm
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(self._conf)
        self._jvm = jvm

    def _manifest(self, number: int) -> str:
        return f"{self.folder}/{MANIFESTS}/{number:020d}.json"

    def versions(self) -> list[int]:
        """The numbers of all manifests, ascending."""
        place = self._path(f"{self.folder}/{MANIFESTS}")
        if not self._fs.exists(place):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(place)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, number: int | None = None) -> dict[str, dict]:
        """name -> {path, schema} of a version, by default the last; {} if there is none."""
        number = number if number is not None else max(self.versions(), default=0)
        if not number:
            return {}
        stream = self._fs.open(self._path(self._manifest(number)))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def read(self, name: str, number: int | None = None) -> DataFrame:
        entry = self.manifest(number)[name]
        columns = T.StructType.fromJson(entry["schema"])
        path = f"{self.folder}/{entry['path']}"
        return self.spark.read.schema(columns).parquet(path).select(*[f"`{c}`" for c in columns.names])

    def write(self, tables: dict[str, DataFrame], partition_by: dict[str, str] | None = None,
              sort_by: dict[str, str] | None = None) -> dict[str, DataFrame]:
        """Replace these tables at once; scans of the new ones."""
        with self.writer() as out:
            for name, df in tables.items():
                out.add(name, df, (partition_by or {}).get(name), (sort_by or {}).get(name))
        return out.scans

    def writer(self) -> Writer:
        return Writer(self)

    def _swap(self, tables: dict[str, dict], base: int) -> int:
        """Commit: the manifest after `base` with these entries, or after what came since."""
        while True:
            last = max(self.versions(), default=0)
            old, now = self.manifest(base) if base else {}, self.manifest(last) if last else {}
            if any(old.get(name) != now.get(name) for name in tables):
                raise Conflict(f"replaced meanwhile: {sorted(n for n in tables if old.get(n) != now.get(n))}")
            waiting = self._path(f"{self.folder}/{MANIFESTS}/.{uuid.uuid4().hex}")
            stream = self._fs.create(waiting, True)
            try:
                stream.write(bytearray(json.dumps(now | tables).encode()))
            finally:
                stream.close()
            if self._renamed(waiting, self._path(self._manifest(last + 1))):
                return last + 1
            self._fs.delete(waiting, False)

    def _renamed(self, source, target) -> bool:
        """Whether the rename took place; never onto an existing file."""
        from py4j.protocol import Py4JJavaError

        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self._conf)
        none = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        try:
            context.rename(source, target, self.spark.sparkContext._gateway.new_array(none, 0))
        except Py4JJavaError as error:
            if "FileAlreadyExists" in str(error.java_exception.getClass().getName()):
                return False
            raise
        return True

    def vacuum(self, keep: int = KEPT, orphans: bool = False) -> list[str]:
        """Delete manifests but the last `keep`, and the data that only those name; with
        `orphans` also data that no manifest names: only while nobody writes."""
        numbers = self.versions()
        gone, kept = numbers[:-keep] if keep else numbers, numbers[-keep:] if keep else []
        used = {e["path"].split("/")[0] for n in kept for e in self.manifest(n).values()}
        old = {e["path"].split("/")[0] for n in gone for e in self.manifest(n).values()}
        if orphans:
            old |= {s.getPath().getName() for s in self._fs.listStatus(self._path(self.folder))
                    if s.getPath().getName().startswith("v-")}
        for number in gone:  # first what names the data
            self._fs.delete(self._path(self._manifest(number)), False)
        dropped = sorted(old - used)
        for name in dropped:
            drop(self.spark, f"{self.folder}/{name}")
        return dropped


def scan(spark: SparkSession, path: str) -> DataFrame:
    """A stored table: the last version of a folder or of a set's member, or plain files."""
    folder, _, name = path.rstrip("/").rpartition("/")
    for place, table in ((path, TABLE), (folder, name)):
        if place and table in Snapshots(spark, place).manifest():
            return Snapshots(spark, place).read(table)
    return spark.read.parquet(path)


class Writer:
    """A write in work: tables are added one by one and appear together at the end."""

    def __init__(self, store: Snapshots):
        self.store = store
        self.base = max(store.versions(), default=0)
        self.version = f"v-{uuid.uuid4().hex}"
        self.entries: dict[str, dict] = {}
        self.scans: dict[str, DataFrame] = {}

    def add(self, name: str, df: DataFrame, partition_by: str | None = None,
            sort_by: str | None = None) -> DataFrame:
        """Write the table's data and return a scan of it; later tables may read it."""
        path = f"{self.store.folder}/{self.version}/{name}"
        write_files(df, path, partition_by, sort_by)
        self.entries[name] = {"path": f"{self.version}/{name}", "schema": json.loads(df.schema.json())}
        self.scans[name] = self.store.spark.read.schema(df.schema).parquet(path).select(
            *[f"`{c}`" for c in df.columns])
        return self.scans[name]

    def commit(self) -> int:
        return self.store._swap(self.entries, self.base)

    def __enter__(self) -> Writer:
        return self

    def __exit__(self, kind, *_) -> None:
        if kind is None:
            try:
                self.commit()
                return
            except Conflict:
                drop(self.store.spark, f"{self.store.folder}/{self.version}")
                raise
        drop(self.store.spark, f"{self.store.folder}/{self.version}")
