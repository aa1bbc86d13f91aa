"""Tables that change at once: a version is written aside and becomes current by a commit.

A table's folder holds ``data/version=<id>/`` folders and ``_commits/<number>.json``, small
files that name the folders that belong to the table and its columns. The highest number
is current. A commit is written under another name and renamed when complete, so a reader
sees the table before or after it, never half of it, and a write that fails leaves the
table as it was. The folders of the commit before stay for readers that still use them;
older ones are removed.

The columns are in the commit, so opening a table reads no file footers, and its parts
(the days of a history) are in it too, so finding one lists no folders.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from tripartite.session import freed, tuned
from tripartite.sources.scratch import PACKED, drop_folder


# Files that a task writes side by side, one for each value of the partition column, without
# sorting its rows by that column first; with more values it goes on to sort.
_SIDE_BY_SIDE = {"spark.sql.maxConcurrentOutputFileWriters": "16"}


class PublishConflict(RuntimeError):
    """Another run has published the table since it was opened."""


@dataclass(frozen=True)
class Commit:
    """Folders of a table's parts, below the table's, and its columns."""

    number: int
    parts: dict[str, str]
    schema: StructType


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def folder_exists(spark: SparkSession, path: str) -> bool:
    files, where = _files(spark, path)
    return files.exists(where)


def _commit_file(path: str, number: int) -> str:
    return f"{path}/_commits/{number:012d}.json"


def _read(spark: SparkSession, path: str, number: int) -> Commit:
    files, where = _files(spark, _commit_file(path, number))
    stream = files.open(where)
    try:
        content = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    held = json.loads(content)
    return Commit(number, held["parts"], StructType.fromJson(held["schema"]))


def current(spark: SparkSession, path: str) -> Commit | None:
    """The last commit of a table; None where nothing has been published."""
    files, where = _files(spark, f"{path}/_commits")
    if not files.exists(where):
        return None
    names = [status.getPath().getName() for status in files.listStatus(where)]
    numbers = [int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit()]
    return _read(spark, path, max(numbers)) if numbers else None


def commit(
    spark: SparkSession, path: str, parts: dict[str, str], schema: StructType, after: Commit | None
) -> Commit:
    """Make ``parts`` the table, if ``after`` is still the last commit."""
    made = Commit(after.number + 1 if after else 0, parts, schema)
    target = _commit_file(path, made.number)
    files, where = _files(spark, target)
    aside = _path(spark, f"{path}/_commits/_{uuid.uuid4().hex}")
    out = files.create(aside, False)
    out.write(json.dumps({"parts": parts, "schema": schema.jsonValue()}).encode())
    out.close()
    if files.exists(where) or not files.rename(aside, where):
        files.delete(aside, False)
        raise PublishConflict(f"{path} has changed since it was opened")
    if after:
        _forget(spark, path, after, made)
    return made


def _forget(spark: SparkSession, path: str, before: Commit, made: Commit) -> None:
    """Remove the commit before ``before``, and what only it refers to."""
    number = before.number - 1
    if number < 0 or not folder_exists(spark, _commit_file(path, number)):
        return
    old = _read(spark, path, number)
    kept = {*before.parts.values(), *made.parts.values()}
    for folder in set(old.parts.values()) - kept:
        drop_folder(spark, f"{path}/{folder}")
    drop_folder(spark, _commit_file(path, number))


@dataclass(frozen=True)
class Version:
    """Rows written beside a table, not part of it until :meth:`publish`."""

    spark: SparkSession
    path: str
    folder: str
    schema: StructType

    def read(self) -> DataFrame:
        rows = self.spark.read.schema(self.schema).parquet(f"{self.path}/{self.folder}")
        return rows.select(*[f"`{c}`" for c in self.schema.names])

    def publish(self) -> Commit:
        """Replace the whole table by this version."""
        return commit(self.spark, self.path, {"": self.folder}, self.schema, current(self.spark, self.path))

    def discard(self) -> None:
        drop_folder(self.spark, f"{self.path}/{self.folder}")


def write_version(df: DataFrame, path: str, *partition_by: str) -> Version:
    """Write ``df`` as a version of the table at ``path``; a failed write leaves no folder."""
    spark = df.sparkSession
    version = Version(spark, path, f"data/version={uuid.uuid4().hex}", df.schema)
    try:
        with tuned(spark, _SIDE_BY_SIDE), freed(spark):
            df.write.partitionBy(*partition_by).option("compression", PACKED).parquet(f"{path}/{version.folder}")
    except BaseException:
        version.discard()
        raise
    return version


def publish_table(df: DataFrame, path: str, *partition_by: str) -> DataFrame:
    """Replace the table at ``path`` by ``df`` and open it."""
    version = write_version(df, path, *partition_by)
    version.publish()
    return version.read()


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a table that is replaced as a whole."""
    last = current(spark, path)
    if last is None:
        raise FileNotFoundError(f"nothing has been published at {path}")
    return Version(spark, path, last.parts[""], last.schema).read()


def read_parts(spark: SparkSession, path: str, held: Commit) -> DataFrame:
    """The parts of a table of many, with the columns that their folders' names carry."""
    folders = [f"{path}/{folder}" for folder in held.parts.values()]
    if not folders:
        return spark.createDataFrame([], held.schema)
    inside = StructType(list(held.schema)).add("version", StringType())
    rows = spark.read.schema(inside).option("basePath", f"{path}/data").parquet(*folders)
    return rows.select(*[f"`{c}`" for c in held.schema.names])


def grown(before: StructType | None, new: StructType) -> StructType:
    """``before`` and behind it the columns that only ``new`` has. A column keeps its type."""
    columns = {f.name: f for f in before or []}
    for f in new:
        known = columns.setdefault(f.name, f)
        if known.dataType != f.dataType:
            raise ValueError(f"column {f.name} is {known.dataType.simpleString()}, not {f.dataType.simpleString()}")
    return StructType([StructField(f.name, f.dataType) for f in columns.values()])
