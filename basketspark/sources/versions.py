"""Tables as versions: folders of data that never change, and small numbered commit files that say which one a table is.

    table/_data-<id>/part-*.parquet      written once, never renamed
    table/_commits/00000000000000000007  {"version": 7, "folder": "_data-<id>", "rows": ..., "columns": ...}

A reader takes the commit of the highest number and reads its folder; there is always one, whatever a writer is doing. A writer
writes its data into a folder of its own, then the commit file under a name of its own, and last gives that file the next number, if no
one else has it: one rename of one small file (or one put, where a store knows no rename), never one of data. Crashing before that
leaves the table as it was, with a folder that nobody reads; crashing after it leaves the new table. The folder of the version before
stays, so that readers who began with it can end. Two writers can't take one number where the store refuses to rename onto a name that
is there (as HDFS does; on a local disk only if they are not at it in the same instant). A folder of plain Parquet files without commits is read as it is.
"""

from __future__ import annotations

import json
import time
from typing import NamedTuple
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

COMMITS, DATA = "_commits", "_data-"
#: How many versions stay readable after a write, and for how long a folder without a commit may still be one that is being written.
KEEP, ORPHAN_HOURS = 2, 72.0
#: Times that a writer tries the next number after another writer took the one before.
TRIES = 100


class Commit(NamedTuple):
    version: int
    folder: str
    rows: int | None
    columns: str | None


class Store:
    """The file system of a table's folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.jvm, self.root = spark, spark._jvm, path.rstrip("/")
        self.fs = self.at().getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, *below: str):
        return self.jvm.org.apache.hadoop.fs.Path("/".join((self.root, *below)))

    def exists(self, *below: str) -> bool:
        return self.fs.exists(self.at(*below))

    def names(self, *below: str) -> list[str]:
        at = self.at(*below)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def read(self, *below: str) -> str:
        stream = self.fs.open(self.at(*below))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, text: str, *below: str) -> None:
        stream = self.fs.create(self.at(*below), False)
        stream.write(bytearray(text.encode()))
        stream.close()

    def delete(self, *below: str) -> None:
        self.fs.delete(self.at(*below), True)

    def age_hours(self, *below: str) -> float:
        return (time.time() - self.fs.getFileStatus(self.at(*below)).getModificationTime() / 1000) / 3600

    def claim(self, source: tuple[str, ...], target: tuple[str, ...], text: str) -> bool:
        """Give a file its name unless that is taken; False if it is."""
        fs = self.jvm.org.apache.hadoop.fs
        try:
            context = fs.FileContext.getFileContext(self.at().toUri(), self.spark._jsc.hadoopConfiguration())
            context.rename(self.at(*source), self.at(*target), self.spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 0))
        except Py4JJavaError as e:
            kind = e.java_exception.getClass().getSimpleName()
            if kind == "UnsupportedFileSystemException" and not self.exists(*target):
                self.put(text, *target)
            elif kind != "FileAlreadyExistsException" and not self.exists(*target):
                raise
            else:
                return False
        return True


def _name(version: int) -> str:
    return f"{version:020d}"


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions that can be read, oldest first; none for plain folders and where there is nothing."""
    store = Store(spark, path)
    folder = store.exists() and store.fs.getFileStatus(store.at()).isDirectory()
    return [int(n) for n in store.names(COMMITS) if n.isdigit()] if folder else []


def commit_of(spark: SparkSession, path: str, version: int | None = None) -> Commit | None:
    """The commit of a version, the newest if none is named; None for a folder without commits."""
    known = versions(spark, path)
    if not known and version is None:
        return None
    if version is not None and version not in known:
        raise ValueError(f"{path} has no version {version}, only {known}")
    return Commit(**json.loads(Store(spark, path).read(COMMITS, _name(known[-1] if version is None else version))))


def data_path(spark: SparkSession, path: str, version: int | None = None) -> str:
    """Where the table's files are."""
    found = commit_of(spark, path, version)
    return f"{path.rstrip('/')}/{found.folder}" if found else path


def new_folder() -> str:
    """The name of a folder for data, below the table's; readers of the folders above leave it out."""
    return f"{DATA}{uuid4().hex}"


def commit(spark: SparkSession, path: str, folder: str, rows: int | None = None, columns: str | None = None, base: int | None = None) -> int:
    """Make a written folder the table. With ``base``, only if that is still the newest version (0: none); else the later one wins."""
    store, draft = Store(spark, path), f"_draft-{uuid4().hex}"
    for _ in range(TRIES):
        newest = max(versions(spark, path), default=0)
        if base is not None and newest != base:
            raise RuntimeError(f"{path} is at version {newest}, not {base} any more")
        text = json.dumps(Commit(newest + 1, folder, rows, columns)._asdict())
        store.put(text, COMMITS, draft)
        try:
            if store.claim((COMMITS, draft), (COMMITS, _name(newest + 1)), text):
                return newest + 1
        finally:
            store.delete(COMMITS, draft)
    raise RuntimeError(f"{path}: others commit all the time")


def discard(spark: SparkSession, path: str, folder: str) -> None:
    """Remove what a writer wrote without committing it, and the table's folder if nothing else is there."""
    store = Store(spark, path)
    store.delete(folder)
    if store.exists() and not store.names():
        store.delete()


def retire(spark: SparkSession, path: str, keep: int = KEEP, orphan_hours: float | None = None) -> list[str]:
    """Remove versions before the last ``keep``, plain files from before the first commit, and, if hours are given, folders that no
    commit names and that are older. What was removed, by name. A commit goes before its data, so none ever names what is gone."""
    store, known = Store(spark, path), versions(spark, path)
    if keep < 1:
        raise ValueError("the newest version stays")
    if not known:
        return []
    stay, gone = known[-keep:], []
    for v in (v for v in known if v not in stay):
        folder = commit_of(spark, path, v).folder
        store.delete(COMMITS, _name(v))
        gone.append(folder)
    named = {commit_of(spark, path, v).folder for v in stay}
    for name in store.names():
        # Spark's own files are what the table was before its first commit; anything else isn't this table's.
        plain = (name.startswith("part-") or "=" in name or name == "_SUCCESS") and len(known) >= keep
        orphan = orphan_hours is not None and name.startswith(DATA) and name not in gone and store.age_hours(name) >= orphan_hours
        if plain or orphan:
            gone.append(name)
    gone = [n for n in dict.fromkeys(gone) if n not in named]
    for name in gone:
        store.delete(name)
    return gone
