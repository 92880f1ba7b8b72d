"""Versioned tables: every version of a warehouse is one manifest that names the folders of all its tables.

A write puts its files into folders of their own and shows them to nobody. Committing creates the next
manifest, a single file that must not exist yet, so it needs neither rename nor overwrite: it works on
object stores, two writers cannot commit the same version, and a reader that holds a version sees all tables
as they were together, however long a later run takes. A run that fails leaves the version before it.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators.merge import Fact
from tickloom.session import child_names, delete_path, file_system, path_exists

#: Folder level below a day that tells one write from another.
WRITE = "w"
#: Table name to the folders, below the table's own, that hold it.
Tables = dict[str, list[str]]


class ConcurrentCommit(RuntimeError):
    """Another writer has committed the version that this one was to become."""


@dataclass
class Snapshots:
    """The versions of the tables below ``root``."""

    root: str
    _pending: Tables | None = field(default=None, repr=False)
    _base: int = field(default=0, repr=False)
    _written: list[str] = field(default_factory=list, repr=False)

    def _manifest(self, version: int) -> str:
        return f"{self.root}/_versions/{version:012d}.json"

    def versions(self, spark: SparkSession) -> list[int]:
        """All committed versions, ascending."""
        names = child_names(spark, f"{self.root}/_versions")
        return sorted(int(m[1]) for m in (re.fullmatch(r"(\d{12})\.json", n) for n in names) if m)

    def tables(self, spark: SparkSession, version: int | None = None) -> Tables:
        """What a version consists of: the one given, what is being written, or the latest."""
        if version is None:
            if self._pending is not None:
                return self._pending
            version = max(self.versions(spark), default=0)
        if not version:
            return {}
        fs, where = file_system(spark, self._manifest(version))
        stream = fs.open(where)
        try:
            text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)["tables"]

    @contextmanager
    def change(self, spark: SparkSession) -> Iterator[None]:
        """All writes inside become the next version together, or none does. A change within a change is part of it."""
        if self._pending is not None:
            yield
            return
        self._base = max(self.versions(spark), default=0)
        self._pending, self._written = {k: list(v) for k, v in self.tables(spark).items()}, []
        try:
            yield
            self._publish(spark, self._base + 1, self._pending)
        except BaseException:
            for folder in self._written:
                delete_path(spark, folder)
            raise
        finally:
            self._pending = None

    def _publish(self, spark: SparkSession, version: int, tables: Tables) -> None:
        fs, where = file_system(spark, self._manifest(version))
        body = json.dumps({"version": version, "tables": tables}).encode()
        try:
            stream = fs.create(where, False)
        except Exception as error:
            if path_exists(spark, self._manifest(version)):
                raise ConcurrentCommit(f"version {version} of {self.root} is another writer's") from error
            raise
        try:
            stream.write(bytearray(body))
        finally:
            stream.close()

    def put(self, spark: SparkSession, table: str, folders: list[str], replace: bool) -> None:
        """Let a table consist of new ``folders``; of the old ones those stay whose day is not among them."""
        days = {f.rpartition("/")[0] for f in folders}
        old = [] if replace else [f for f in self._pending.get(table, []) if f.rpartition("/")[0] not in days]
        self._pending[table] = sorted(old + folders)
        self._written += [f"{self.root}/{table}/{f}" for f in folders]

    def expire(self, spark: SparkSession, keep: int = 2) -> int:
        """Delete all but the newest ``keep`` versions, and the folders that none of those names; returns how many folders.

        Not while a writer is at work, and not while a reader still holds an older version.
        """
        versions = self.versions(spark)
        for version in versions[: max(0, len(versions) - keep)]:
            delete_path(spark, self._manifest(version))
        named: dict[str, set[str]] = {}
        for version in versions[-keep:]:
            for table, folders in self.tables(spark, version).items():
                named.setdefault(table, set()).update(folders)
        gone = 0
        for table, kept in named.items():
            for day in child_names(spark, f"{self.root}/{table}"):
                for write in child_names(spark, f"{self.root}/{table}/{day}"):
                    if write.startswith(f"{WRITE}=") and f"{day}/{write}" not in kept:
                        delete_path(spark, f"{self.root}/{table}/{day}/{write}")
                        gone += 1
        return gone


@dataclass(frozen=True)
class VersionedFact(Fact):
    """A fact whose days are the folders that the current version names. Writing needs a change to be open."""

    snapshots: Snapshots | None = None
    version: int | None = None

    @property
    def name(self) -> str:
        return self.path.rpartition("/")[2]

    def _folders(self, spark: SparkSession) -> list[str]:
        return self.snapshots.tables(spark, self.version).get(self.name, [])

    def read(self, spark: SparkSession) -> DataFrame:
        folders = self._folders(spark)
        if not folders:
            return spark.createDataFrame([], self.schema)
        schema = T.StructType([*self.schema.fields, T.StructField(WRITE, T.StringType())])
        rows = spark.read.schema(schema).option("basePath", self.path).parquet(*(f"{self.path}/{f}" for f in folders))
        return rows.select(*self.schema.names)

    def exists(self, spark: SparkSession) -> bool:
        return self.name in self.snapshots.tables(spark, self.version)

    def watermark(self, spark: SparkSession) -> dt.date | None:
        """Latest stored day, from the manifest alone."""
        days = [f.partition("/")[0].partition("=")[2] for f in self._folders(spark)]
        return max((dt.date.fromisoformat(d) for d in days if d[:1].isdigit()), default=None)

    def at(self, version: int) -> VersionedFact:
        """The fact as it was in a version."""
        return VersionedFact(self.path, self.schema, self.key, self.day, self.cluster, self.snapshots, version)

    def _write(self, df: DataFrame, mode: str) -> None:
        spark, write = df.sparkSession, uuid.uuid4().hex
        with self.snapshots.change(spark):
            rows = df.select(*self.schema.names).hint("rebalance", self.day).sortWithinPartitions(self.day, self.cluster)
            rows.withColumn(WRITE, F.lit(write)).write.mode("append").partitionBy(self.day, WRITE).parquet(self.path)
            days = [d for d in child_names(spark, self.path) if d.startswith(f"{self.day}=")]
            folders = [f"{d}/{WRITE}={write}" for d in days if path_exists(spark, f"{self.path}/{d}/{WRITE}={write}")]
            self.snapshots.put(spark, self.name, folders, replace=mode == "static")


def write_table(snapshots: Snapshots, df: DataFrame, name: str) -> None:
    """Replace a small table, as part of the change that is open."""
    spark, folder = df.sparkSession, f"all/{WRITE}={uuid.uuid4().hex}"
    with snapshots.change(spark):
        df.coalesce(1).write.parquet(f"{snapshots.root}/{name}/{folder}")
        snapshots.put(spark, name, [folder], replace=True)


def read_table(spark: SparkSession, snapshots: Snapshots, name: str, schema: T.StructType, version: int | None = None) -> DataFrame:
    """A small table as the current version, or the one given, has it."""
    folders = snapshots.tables(spark, version).get(name)
    if not folders:
        raise AnalysisException(f"{name} is in no version of {snapshots.root}")
    return spark.read.schema(schema).parquet(*(f"{snapshots.root}/{name}/{f}" for f in folders))
