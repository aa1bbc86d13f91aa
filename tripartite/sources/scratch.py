"""Intermediate tables in the folder the cluster shares.

A frame that several later jobs read is written once and read back, which cuts
its lineage: a lost executor costs the tasks it was running and nothing upstream.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from tripartite.session import freed, together

SHARED_DIR_CONF = "spark.checkpoint.dir"
PACKED = "zstd"  # intermediate tables: written and read once or twice, so size counts most

_workspace: ContextVar[str | None] = ContextVar("workspace", default=None)


def shared_dir(spark: SparkSession) -> str:
    """Shared folder named by the session; a temporary one in local mode only."""
    folder = spark.conf.get(SHARED_DIR_CONF, None)
    if folder:
        return folder.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise ValueError(f"set {SHARED_DIR_CONF} to a folder every executor can reach")
    return tempfile.mkdtemp(prefix="tripartite-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder for ``name``: in the open :func:`workspace`, or else in the shared folder."""
    root = _workspace.get() or f"{shared_dir(spark)}/tripartite"
    return f"{root}/{uuid.uuid4().hex}/{name}"


@contextmanager
def workspace(spark: SparkSession) -> Iterator[str]:
    """A folder for all intermediate tables written in a with block, removed at its end.

    Results are lazy and read those tables, so write or collect them inside the block.
    """
    root = f"{shared_dir(spark)}/tripartite/{uuid.uuid4().hex}"
    token = _workspace.set(root)
    try:
        yield root
    finally:
        _workspace.reset(token)
        drop_folder(spark, root)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of intermediate tables, wherever the shared file system is."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Length of all files in a folder."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.getContentSummary(where).getLength()


def source_bytes(*tables: DataFrame) -> int:
    """Length of the files that some tables read, each folder counted once.

    The files behind the leaves of a plan, not the optimizer's estimate of its result,
    which multiplies the sides of a join.
    """
    read: dict[str, int] = {}
    for table in tables:
        leaves = table._jdf.queryExecution().analyzed().collectLeaves()
        for leaf in map(leaves.apply, range(leaves.size())):
            relation = leaf.relation() if leaf.getClass().getSimpleName() == "LogicalRelation" else None
            if relation is not None and relation.getClass().getSimpleName() == "HadoopFsRelation":
                files = relation.location()
                read[files.rootPaths().mkString("\n")] = files.sizeInBytes()
            else:  # not files: what the source itself says
                read[str(leaf.hashCode())] = int(str(leaf.stats().sizeInBytes()))
    return sum(read.values())


def write_through(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as parquet and return a scan of what was written."""
    spark = df.sparkSession
    target = path or scratch_path(spark, name)
    with freed(spark):
        df.write.mode("overwrite").option("compression", PACKED).parquet(target)
    return spark.read.schema(df.schema).parquet(target)


def write_all(tables: dict[str, DataFrame], root: str | None = None) -> dict[str, DataFrame]:
    """:func:`write_through` for several tables at once, as ``root/<name>``."""
    spark = next(iter(tables.values())).sparkSession

    def write(name: str) -> Callable[[], DataFrame]:
        return lambda: write_through(tables[name], name, f"{root}/{name}" if root else None)

    return dict(zip(tables, together(spark, *map(write, tables)), strict=True))
