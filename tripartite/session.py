"""Session settings the library relies on, and their sizing."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import copy_context
from threading import Lock
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Settable on a running session. Skewed joins are split even where the split
# costs one more shuffle: an aggregate on the join key would otherwise keep a
# hot key in a single task.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # With ANSI off a bad amount or date would become null in staging, without a word.
    "spark.sql.ansi.enabled": "true",
}

_WIDTH = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_SCAN = "spark.sql.files.maxPartitionBytes"
_TASK_BYTES = 256 << 20
_MOST_PARTITIONS = 32_768
_LARGEST_SPLIT = 1 << 30

# Bytes of rows in a shuffle for a byte of their packed files.
UNFOLDED = 8

_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_freeing: dict[str, tuple[int, str | None]] = {}  # by session: blocks that are open, the setting before
_changing = Lock()


def tune(spark: SparkSession, input_bytes: int | None = None) -> SparkSession:
    """Apply :data:`RUNTIME_CONF` to the session; size its shuffles if the input is known.
    The settings stay until the session ends; :func:`tuned` gives them back."""
    for key, value in (RUNTIME_CONF | ({} if input_bytes is None else sized(spark, input_bytes))).items():
        spark.conf.set(key, value)
    return spark


def width(spark: SparkSession, input_bytes: int) -> int:
    """Partitions of a shuffle over ``input_bytes`` of files: some 256 MB each, one for
    each core at least, and 32,768 at most (at 100 TB 3 GB each, which a sort spills)."""
    wanted = max(spark.sparkContext.defaultParallelism, -(-input_bytes // _TASK_BYTES))
    return min(wanted, _MOST_PARTITIONS)


def sized(spark: SparkSession, input_bytes: int) -> dict[str, str]:
    """Settings for jobs over ``input_bytes`` of files.

    A shuffle starts :func:`width` wide and adaptive execution merges what turns out
    small. Scans are cut larger as the input grows, up to 1 GB, so that the blocks of a
    shuffle, map tasks times reduce tasks, stay within what a driver can keep track of.
    """
    split = min(max(128 << 20, input_bytes // _MOST_PARTITIONS), _LARGEST_SPLIT)
    return {_WIDTH: str(width(spark, input_bytes)), _SCAN: str(split)}


@contextmanager
def tuned(spark: SparkSession, settings: dict[str, str] = RUNTIME_CONF) -> Iterator[None]:
    """``settings`` for the length of a with block; what was set before comes back."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query that runs in a with block go when it has run, not when the
    driver collects its garbage. For what is run once, such as a write: run again, it would
    shuffle again. Blocks may overlap in threads."""
    session = spark._jsparkSession.sessionUUID()
    with _changing:
        blocks, before = _freeing.get(session) or (0, spark.conf.get(_FREED, None))
        _freeing[session] = blocks + 1, before
        spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        with _changing:
            blocks, before = _freeing.pop(session)
            if blocks > 1:
                _freeing[session] = blocks - 1, before
            elif before is None:
                spark.conf.unset(_FREED)
            else:
                spark.conf.set(_FREED, before)


def together(spark: SparkSession, *actions: Callable[[], Any]) -> list[Any]:
    """Run independent Spark actions at the same time and return their results.

    Each is a job of its own; the cluster fills the tail of one with the tasks of
    another.
    """
    with ThreadPoolExecutor(len(actions)) as pool:
        started = [
            pool.submit(copy_context().run, inheritable_thread_target(spark)(action)) for action in actions
        ]
        return [action.result() for action in started]
