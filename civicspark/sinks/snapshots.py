"""Snapshot tables: versioned folders with one commit point.

A table is a folder with ``data/<id>``, one folder of Parquet files per write,
and ``commits/<number>.json``, one small file per committed version that names
its data folder. A write first puts all its files where no reader looks, then
creates the next commit file: the file system creates it only if it is not
there, so of two writers one gets the number and the other takes the next one.
(Hadoop's local file system looks and creates in two steps, so writers of one
process take turns; those of several need a store that creates in one step.)
Readers take the highest commit. Nothing is moved, renamed over or deleted on
the way, so a job that fails anywhere before the commit leaves the version
before readable, on object stores too, and readers that have begun go on
undisturbed. :func:`remove_old_versions` frees space when asked.
"""

from __future__ import annotations

import json
import threading
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from civicspark.session import delete_path

_DIGITS = 20
_ATTEMPTS = 100
_creating = threading.Lock()


class NoSnapshotError(FileNotFoundError):
    """The folder holds no committed version, or not the one asked for."""


@dataclass(frozen=True)
class Snapshot:
    """A committed version: its number, the folder of its files, and the partition columns of its layout."""

    version: int
    path: str


class _Folder:
    """The file system calls behind a table's commits, by the Hadoop client that Spark writes with."""

    def __init__(self, spark: SparkSession, root: str):
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self.root = root.rstrip("/")
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._jvm = jvm

    def commits(self) -> list[int]:
        folder = self._path(f"{self.root}/commits")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n.removesuffix(".json").isdigit())

    def _commit(self, version: int):
        return self._path(f"{self.root}/commits/{version:0{_DIGITS}d}.json")

    def create(self, version: int, text: str) -> bool:
        """Create a commit file; False if it is there already."""
        self._fs.mkdirs(self._path(f"{self.root}/commits"))
        with _creating:
            try:
                out = self._fs.create(self._commit(version), False)
            except Exception as e:
                if self._fs.exists(self._commit(version)):
                    return False
                raise OSError(f"cannot commit version {version} below {self.root}") from e
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        return True

    def read(self, version: int) -> dict:
        stream = self._fs.open(self._commit(version))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode() or "{}")
        finally:
            stream.close()


def snapshots(spark: SparkSession, root: str) -> list[Snapshot]:
    """Committed versions, oldest first. A commit file that is still empty (its writer died in between) is none."""
    folder = _Folder(spark, root)
    found = ((v, folder.read(v)) for v in folder.commits())
    return [Snapshot(v, f"{folder.root}/{said['data']}") for v, said in found if said.get("data")]


def current_snapshot(spark: SparkSession, root: str, version: int | None = None) -> Snapshot:
    """The latest committed version, or the one asked for."""
    folder = _Folder(spark, root)
    for v in reversed(folder.commits()):
        if version in (None, v) and (said := folder.read(v)).get("data"):
            return Snapshot(v, f"{folder.root}/{said['data']}")
    raise NoSnapshotError(f"no committed version{'' if version is None else f' {version}'} below {root}")


def stage_snapshot(df: DataFrame, root: str, partition_by: list[str] | None = None) -> str:
    """Write the files of a next version where no reader looks; returns their folder."""
    path = f"{root.rstrip('/')}/data/{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return path


def commit_snapshot(spark: SparkSession, root: str, staged: str) -> Snapshot:
    """Make a staged folder the current version: one file is created, and from then on readers see it."""
    folder = _Folder(spark, root)
    data = staged.removeprefix(f"{folder.root}/")
    if data == staged:
        raise ValueError(f"{staged} does not lie below {root}")
    for _ in range(_ATTEMPTS):
        version = max(folder.commits(), default=0) + 1
        if folder.create(version, json.dumps({"data": data})):
            return Snapshot(version, staged)
    raise OSError(f"{_ATTEMPTS} commits below {root} came in between")


def discard_snapshot(spark: SparkSession, root: str, staged: str) -> None:
    """Delete a staged folder that will not be committed, and the table's folder if it has no version."""
    if any(s.path == staged for s in snapshots(spark, root)):
        raise ValueError(f"{staged} is committed")
    delete_path(spark, staged)
    if not _Folder(spark, root).commits():
        delete_path(spark, root)


def write_snapshot(df: DataFrame, root: str, partition_by: list[str] | None = None) -> Snapshot:
    """Replace the table by ``df``, which may read the version before."""
    return commit_snapshot(df.sparkSession, root, stage_snapshot(df, root, partition_by))


def read_snapshot(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The current version of a table, or an earlier one that has not been removed."""
    snapshot = current_snapshot(spark, root, version)
    try:
        return spark.read.parquet(snapshot.path)
    except AnalysisException as e:
        raise NoSnapshotError(f"the files of version {snapshot.version} below {root} are gone") from e


def register_snapshot(spark: SparkSession, table_name: str, root: str) -> Snapshot:
    """Point a catalog table at the current version.

    A table that exists keeps its name and only gets another location and
    schema, so a query finds the old files or the new ones.
    """
    if not table_name.isidentifier():
        raise ValueError(f"Invalid table name: '{table_name}'")
    snapshot = current_snapshot(spark, root)
    new = spark.read.parquet(snapshot.path).schema
    if spark.catalog.tableExists(table_name):
        old = spark.table(table_name).schema
        if [(f.name, f.dataType) for f in old] == [(f.name, f.dataType) for f in new]:
            spark.sql(f"ALTER TABLE `{table_name}` SET LOCATION '{snapshot.path}'")
            spark.catalog.refreshTable(table_name)
            return snapshot
        spark.sql(f"DROP TABLE `{table_name}`")  # an external table: its files stay
    spark.catalog.createTable(table_name, path=snapshot.path, source="parquet")
    return snapshot


def remove_old_versions(spark: SparkSession, root: str, keep: int = 1) -> list[int]:
    """Delete the files of all but the last ``keep`` versions; returns the versions removed. Data that was never committed stays."""
    if keep < 1:
        raise ValueError(f"keep must be >= 1, got {keep}")
    known = snapshots(spark, root)
    used = {s.path for s in known[-keep:]}
    gone = [s for s in known[:-keep] if s.path not in used]
    for s in gone:
        delete_path(spark, s.path)
    return [s.version for s in gone]
