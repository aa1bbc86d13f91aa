"""Dense numbering of a whole table in a given order, without one task seeing it all.

``row_number() over (order by ...)`` moves every row to one task. Numbering per
``opened_at`` instead would still funnel a busy day through one task. Here the
rows are range-partitioned on the full sort key, which also splits a single hot
day, and written in that order, a file or more per partition. A row's number is its
place in its file, which the scan knows, and the rows of the files before, which
their footers tell.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripartite.operators.detect import HIGH_AFTER_DAYS, SLA_DAYS, not_yet_late, tell, told
from tripartite.schemas import FACT_COLUMNS
from tripartite.session import UNFOLDED, freed, sized, tuned
from tripartite.sources.scratch import PACKED, drop_folder, folder_bytes, scratch_path, source_bytes

# (break_type, entity_id) identifies a break, so the first three columns leave no
# ties; the others keep the order fixed where the source keys repeat all the same.
BREAK_ORDER = ["opened_at", "entity_id", "break_type", "amount_at_risk", "description"]

# A written file's name: the task's partition, then its number among that task's files.
_PARTITION = r"^part-(\d+)-"
_FILE = r"-c(\d+)[^/-]*$"  # no dash behind it: the job's id before it may hold "-c1" too


def number_rows(
    df: DataFrame,
    order: list[str | Column],
    number: str = "row_number",
    work: str | None = None,
    beside: DataFrame | None = None,
) -> DataFrame:
    """``df`` with ``number`` = 1..n in the given order; columns given by name ascend,
    nulls last.

    Two tables are written below ``work`` (or in the shared folder). The rows as they
    come: the sort reads its input twice, once to choose the ranges, and is sized by it.
    And the sorted rows: their files stay as they are, even if tasks have to be repeated. The
    former go when they are sorted, unless they lie in ``work``, the caller's to remove.

    Copies of one row cannot be told apart by ``order``; their position in the first
    table can, so a large group of copies is cut like any other range.

    ``beside`` are more rows with the same columns that are read from written files: they are
    numbered with the others, and not written a second time as they come.
    """
    spark = df.sparkSession
    stored, ordered = (f"{work}/{n}" if work else scratch_path(spark, n) for n in ("unordered", "ordered"))
    with freed(spark):
        df.write.mode("overwrite").option("compression", PACKED).parquet(stored)
    ascending = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order]
    rows, size = spark.read.schema(df.schema).parquet(stored), folder_bytes(spark, stored)
    if beside is not None:
        rows, size = rows.unionByName(beside), size + source_bytes(beside)
    with tuned(spark, sized(spark, size * UNFOLDED)), freed(spark):
        (
            rows
            .withColumn("_copy", F.monotonically_increasing_id())
            .orderBy(*ascending, "_copy")
            .drop("_copy")
            .write.mode("overwrite").option("compression", PACKED).parquet(ordered)
        )
    if not work:
        drop_folder(spark, stored)
    placed = spark.read.schema(df.schema).parquet(ordered)
    # No column is read here: the rows of a file without columns are counted in its footer.
    counts = placed.groupBy(F.col("_metadata.file_name").alias("_name")).agg(F.count(F.lit(1)).alias("_rows"))
    # One row per file: small enough for one task and for broadcast.
    at = [F.regexp_extract("_name", pattern, 1).cast("int") for pattern in (_PARTITION, _FILE)]
    before = Window.orderBy(*at).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_name", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    return (
        placed.select("*", F.col("_metadata.file_name").alias("_name"), F.col("_metadata.row_index").alias("_place"))
        .join(F.broadcast(offsets), "_name")
        .selectExpr(*[f"`{c}`" for c in df.columns], f"_offset + _place + 1 as `{number}`")
    )


def with_break_key(breaks: DataFrame, work: str | None = None, beside: DataFrame | None = None) -> DataFrame:
    """The fact: finished breaks plus their surrogate key; ``beside`` as in :func:`number_rows`."""
    return number_rows(breaks, BREAK_ORDER, "break_key", work, beside).select(*FACT_COLUMNS)


def keyed_facts(
    marks: DataFrame,
    beside: DataFrame | None,
    days: Sequence[date],
    sla_days: int = SLA_DAYS,
    high_after_days: int = HIGH_AFTER_DAYS,
    work: str | None = None,
) -> list[DataFrame]:
    """The fact as of each of ``days`` from the marks of the last of them (``beside`` as in
    :func:`number_rows`). Marks are sorted once, whatever the number of days, and told behind
    the sort: rows on their way are short."""
    last = max(days)
    columns = told(last, sla_days, high_after_days)
    order = [F.expr(columns[c]).asc_nulls_last() for c in BREAK_ORDER]
    numbered = number_rows(marks, order, "break_key", work, beside)
    return [
        tell(
            _as_on(numbered, day, last, sla_days), day, "break_key", sla_days=sla_days, high_after_days=high_after_days
        ).select(*FACT_COLUMNS)
        for day in days
    ]


def _as_on(numbered: DataFrame, day: date, last: date, sla_days: int) -> DataFrame:
    """The numbered marks of ``last`` that are breaks on ``day``, numbered among themselves.

    What is not late yet on ``day`` was opened in the days between the two limits. The marks
    before these keep their number, those behind lose as many as there are; only the marks
    opened in between are numbered again.
    """
    early, first = not_yet_late(day, sla_days)
    until = not_yet_late(last, sla_days)[1]
    gone = numbered.where(early).count() if first < until else 0
    if not gone:
        return numbered
    before = numbered.where(F.col("opened") < F.lit(first))
    after = numbered.where(F.col("opened").isNull() | (F.col("opened") >= F.lit(until)))
    between = numbered.where((F.col("opened") >= F.lit(first)) & (F.col("opened") < F.lit(until)))
    base = before.count()
    again = number_rows(between.where(f"not ({early})"), ["break_key"], "_place")
    return (
        before.unionByName(after.withColumn("break_key", F.col("break_key") - F.lit(gone)))
        .unionByName(again.withColumn("break_key", F.col("_place") + F.lit(base)).drop("_place"))
    )
