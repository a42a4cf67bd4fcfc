"""Versioned warehouse: tables written aside, made visible by one rename
(SURVEY §2.9 I1, I7, A13; §2.14 run log, compaction, retention).

Layout below a root folder that all executors share::

    data/load=<id>/table=<name>/[<partition>=<value>/]part-*.parquet
    versions/<12 digits>.json      a manifest: folders of every table
    staging/<load>/<name>/         what a load has staged

A load writes only new folders.  Its last step writes the manifest beside the
others and renames it to the next number; the rename fails if that number
exists, so of two concurrent loads one must start again.  Until then readers
see the old manifest, afterwards all tables of the new one together: a load
that dies between its dimensions and its facts changes nothing.  Partitions a
load does not touch keep their folders, so a version costs what it changed.

A manifest lists a folder per partition (days), not per file or row; the
driver holds it, as it holds the partitions of any table it plans a scan of.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = 12


class CommitConflict(RuntimeError):
    """Another load has made the version that this one wanted to make."""


@dataclass
class Entry:
    """A table in a manifest: its schema, partition column, and folders by
    partition value (one folder under '' without a partition column)."""

    schema: str
    partition: str | None
    folders: dict[str, list[str]] = field(default_factory=dict)


class Pointers:
    """Numbered JSON files in a folder, each made by an atomic rename."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.path(self.folder).getFileSystem(self._conf)

    def path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def children(self, folder: str) -> list[str]:
        path = self.path(folder)
        return [s.getPath().getName() for s in self.fs.listStatus(path)] if self.fs.exists(path) else []

    def _file(self, number: int) -> str:
        return f"{self.folder}/{number:0{DIGITS}d}.json"

    def numbers(self) -> list[int]:
        return sorted(int(n[:DIGITS]) for n in self.children(self.folder) if n.endswith(".json") and n[:DIGITS].isdigit())

    def read(self, number: int) -> dict:
        stream = self.fs.open(self.path(self._file(number)))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def commit(self, content: dict, based_on: int | None) -> int:
        """Write the file after ``based_on`` (None: the first), unless it exists."""
        number = 1 if based_on is None else based_on + 1
        aside, target = self.path(f"{self.folder}/.{uuid.uuid4().hex}"), self.path(self._file(number))
        stream = self.fs.create(aside, False)
        try:
            stream.write(bytearray(json.dumps(content, sort_keys=True).encode()))
        finally:
            stream.close()
        hadoop = self._jvm.org.apache.hadoop.fs
        # a rename of FileContext without options refuses an existing target
        context = hadoop.FileContext.getFileContext(self.fs.getUri(), self._conf)
        try:
            context.rename(aside, target, self.spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0))
        except Exception as error:
            self.fs.delete(aside, False)
            if self.fs.exists(target):
                raise CommitConflict(f"version {number} exists") from error
            raise
        return number

    def delete(self, number: int) -> None:
        self.fs.delete(self.path(self._file(number)), False)


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.pointers = Pointers(spark, f"{self.root}/versions")
        self._fs, self._path = self.pointers.fs, self.pointers.path

    def _children(self, folder: str) -> list[str]:
        return self.pointers.children(f"{self.root}/{folder}")

    # ---- manifests ----------------------------------------------------------

    def versions(self) -> list[int]:
        return self.pointers.numbers()

    def manifest(self, version: int | None = None) -> dict[str, Entry]:
        """Tables of a version, the newest by default; none before the first."""
        versions = self.versions()
        if version is None and not versions:
            return {}
        if version is not None and version not in versions:
            raise ValueError(f"no version {version}")
        return {name: Entry(**entry) for name, entry in self.pointers.read(version or versions[-1]).items()}

    def newest(self) -> tuple[int | None, dict[str, Entry]]:
        """The newest version and its tables: what a load starts from."""
        version = (self.versions() or [None])[-1]
        return version, self.manifest(version)

    def commit(self, tables: dict[str, Entry], based_on: int | None) -> int:
        """Make ``tables`` the version after ``based_on`` (None: the first)."""
        return self.pointers.commit({name: entry.__dict__ for name, entry in tables.items()}, based_on)

    # ---- tables ---------------------------------------------------------------

    def read(self, name: str, version: int | None = None, partitions=None) -> DataFrame | None:
        """A table as of a version; ``partitions`` prunes to these values."""
        entry = self.manifest(version).get(name)
        return None if entry is None else self.rows(entry, partitions)

    def rows(self, entry: Entry, partitions=None) -> DataFrame:
        """A manifest entry's rows."""
        schema = T.StructType.fromJson(json.loads(entry.schema))
        wanted = entry.folders if partitions is None else {p: entry.folders[p] for p in partitions if p in entry.folders}
        folders = [f"{self.root}/{f}" for some in wanted.values() for f in some]
        if not folders:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).option("basePath", f"{self.root}/data").parquet(*folders)
        return rows.select(*schema.names)

    def write(self, name: str, rows: DataFrame, load: str, partition: str | None = None, last=None) -> Entry:
        """Write rows into new folders of a load; nothing sees them before a
        commit.  Rows are clustered by partition value, so that a task writes
        few files; the partition column must be a string.  ``last`` is a step
        on the clustered rows, run by the tasks that write them."""
        folder = f"data/load={load}/table={name}"
        if partition is not None:
            if dict(rows.dtypes)[partition] != "string":
                raise ValueError(f"partition column {partition} must be a string")
            rows = rows.repartition(partition)
        rows = last(rows) if last else rows
        if partition is None:
            rows.write.mode("overwrite").parquet(f"{self.root}/{folder}")
            return Entry(rows.schema.json(), None, {"": [folder]})
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy(partition).parquet(f"{self.root}/{folder}"))
        values = [c.split("=", 1)[1] for c in self._children(folder) if c.startswith(f"{partition}=")]
        return Entry(rows.schema.json(), partition, {v: [f"{folder}/{partition}={v}"] for v in values})

    def appended_entry(self, old: Entry | None, new: Entry) -> Entry:
        """The old table with the new folders beside its own."""
        folders = {v: list(f) for v, f in (old.folders.items() if old else ())}
        for value, more in new.folders.items():
            folders[value] = folders.get(value, []) + more
        return Entry(new.schema, new.partition, folders)

    def merged_entry(self, old: Entry | None, new: Entry, replaced) -> Entry:
        """The old table with partitions ``replaced`` by the new folders."""
        kept = {v: f for v, f in (old.folders.items() if old else ()) if v not in replaced}
        return Entry(new.schema, new.partition, {**kept, **new.folders})

    # ---- staging (A13, I1) ------------------------------------------------------

    def reset_staging(self) -> None:
        """Drop everything earlier loads have staged."""
        self._fs.delete(self._path(f"{self.root}/staging"), True)

    def stage(self, load: str, frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """Append the frames of a load to its staging tables and give
        them back as read from there: the steps of the load then share one
        reading of its source."""
        out = {}
        for name, frame in frames.items():
            path = f"{self.root}/staging/{load}/{name}"
            frame.write.mode("append").parquet(path)
            out[name] = self.spark.read.schema(frame.schema).parquet(path)
        return out

    # ---- upkeep -------------------------------------------------------------------

    def roll_back_to(self, version: int) -> int:
        """A new version with the tables of an older one."""
        return self.commit(self.manifest(version), self.versions()[-1])

    def _files(self, folders: list[str]) -> list[int]:
        sizes = []
        for folder in folders:
            for status in self._fs.listStatus(self._path(f"{self.root}/{folder}")):
                if status.isFile() and not status.getPath().getName().startswith(("_", ".")):
                    sizes.append(status.getLen())
        return sizes

    def compact(self, name: str, target_bytes: int = 256 << 20) -> int | None:
        """Rewrite the partitions of a table that hold more files than their
        size needs, to files of about ``target_bytes``.  Same rows, a new
        version; readers of older ones keep their files."""
        version, tables = self.newest()
        entry = tables[name]
        wanted = {}
        for value, folders in entry.folders.items():
            sizes = self._files(folders)
            needed = max(1, -(-sum(sizes) // target_bytes))
            if len(sizes) > needed:
                wanted[value] = needed
        if not wanted:
            return None
        rows, load = self.rows(entry, list(wanted)), f"compact-{uuid.uuid4().hex}"
        folder = f"data/load={load}/table={name}"
        if entry.partition is None:
            rows.repartition(wanted[""]).write.parquet(f"{self.root}/{folder}")
            new = {"": [folder]}
        else:
            # a partition's rows go to as many tasks as it needs files, so a
            # large one isn't written by a single task
            needed = F.create_map(*[F.lit(x) for pair in wanted.items() for x in pair])[F.col(entry.partition)]
            salted = rows.withColumn("_slot", F.floor(F.rand(7) * needed).cast("int"))
            (salted.repartition(entry.partition, "_slot").drop("_slot").write
             .option("partitionOverwriteMode", "static").partitionBy(entry.partition).parquet(f"{self.root}/{folder}"))
            new = {v: [f"{folder}/{entry.partition}={v}"] for v in wanted}
        tables[name] = Entry(entry.schema, entry.partition, {**entry.folders, **new})
        return self.commit(tables, version)

    def retain(self, name: str, oldest: str) -> int | None:
        """Drop the partitions whose value (a zero-padded date) is below
        ``oldest``, in a new version."""
        version, tables = self.newest()
        entry = tables[name]
        kept = {v: f for v, f in entry.folders.items() if v >= oldest}
        if len(kept) == len(entry.folders):
            return None
        tables[name] = Entry(entry.schema, entry.partition, kept)
        return self.commit(tables, version)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete manifests but the last ``keep`` and the load folders that none
        of those uses.  Not to be run while a load is under way."""
        versions = self.versions()
        kept = versions[-keep:]
        used = {f.split("/")[1] for v in kept for e in self.manifest(v).values() for some in e.folders.values() for f in some}
        for version in versions[:-keep]:
            self.pointers.delete(version)
        gone = [c for c in self._children("data") if c not in used]
        for child in gone:
            self._fs.delete(self._path(f"{self.root}/data/{child}"), True)
        return gone


def distinct_values(rows: DataFrame, column: str) -> list[str]:
    """The partitions a load touches: as many values as it has days."""
    return sorted(r[0] for r in rows.select(column).distinct().collect())
