from datetime import date

import pytest
from pyspark.sql import functions as F

from tripartite import sources
from tripartite.schemas import FACT_SCHEMA, SNAPSHOT_COLUMNS, SNAPSHOT_KEY
from tripartite.sources import (
    delete_insert,
    read_fact,
    read_snapshot,
    snapshot_breaks,
    snapshot_rows,
    write_fact,
)

from conftest import AS_OF, rows

DAY1, DAY2, DAY3 = date(2025, 7, 1), date(2025, 7, 2), date(2025, 7, 3)


def fact(spark, *severities):
    data = [
        (i, "amount_break" if i % 2 else "orphan_claim", s, "contract", f"C{i}", "M1", None,
         date(2025, 6, 1), 30, None, f"text {i}", AS_OF)
        for i, s in enumerate(severities, 1)
    ]
    return spark.createDataFrame(data, FACT_SCHEMA)


def test_history_over_several_runs(spark, tmp_path):
    path = str(tmp_path / "history")
    assert snapshot_breaks(fact(spark, "high", "high"), path, DAY1)
    # The same day again: the first capture stays.
    assert not snapshot_breaks(fact(spark, "medium"), path, DAY1)
    history = read_snapshot(spark, path)
    assert sorted(history.columns) == sorted(SNAPSHOT_COLUMNS)
    assert rows(history, "snapshot_date", "break_key", "severity") == [
        (DAY1, 1, "high"), (DAY1, 2, "high"),
    ]
    # Another day is added.
    assert snapshot_breaks(fact(spark, "medium"), path, DAY2)
    assert read_snapshot(spark, path).count() == 3
    # A new column: null on the days before it.
    assert snapshot_breaks(fact(spark, "high").withColumn("owner", F.lit("ops")), path, DAY3)
    assert rows(read_snapshot(spark, path), "snapshot_date", "owner") == sorted(
        [(DAY1, None), (DAY1, None), (DAY2, None), (DAY3, "ops")], key=repr
    )
    # Full refresh: history is today only.
    assert snapshot_breaks(fact(spark, "high"), path, DAY2, full_refresh=True)
    assert rows(read_snapshot(spark, path), "snapshot_date", "break_key") == [(DAY2, 1)]


def test_known_schema_reads_without_merging(spark, tmp_path):
    path = str(tmp_path / "history")
    first = fact(spark, "high")
    wider = first.withColumn("owner", F.lit("ops"))
    snapshot_breaks(first, path, DAY1)
    snapshot_breaks(wider, path, DAY2)
    read = read_snapshot(spark, path, snapshot_rows(wider, DAY2).schema)
    assert rows(read, "snapshot_date", "owner") == sorted([(DAY1, None), (DAY2, "ops")], key=repr)


def test_default_date_is_today(spark, tmp_path):
    path = str(tmp_path / "history")
    today = spark.range(1).select(F.current_date()).first()[0]
    assert snapshot_breaks(fact(spark, "high"), path)
    assert rows(read_snapshot(spark, path), "snapshot_date") == [(today,)]


def test_one_day_is_read_from_one_partition(spark, tmp_path):
    path = str(tmp_path / "history")
    for day in (DAY1, DAY2):
        snapshot_breaks(fact(spark, "high"), path, day)
    one = read_snapshot(spark, path).where(F.col("snapshot_date") == F.lit(DAY2))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan


def test_fact_is_replaced_and_pruned_by_type(spark, tmp_path):
    path = str(tmp_path / "fact")
    write_fact(fact(spark, "high", "high", "medium"), path)
    write_fact(fact(spark, "high", "medium"), path)
    found = read_fact(spark, path)
    assert rows(found) == rows(fact(spark, "high", "medium"))
    plan = found.where("break_type = 'orphan_claim'")._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [isnotnull(break_type" in plan.toString()


@pytest.mark.parametrize("extra", [False, True])
def test_delete_insert_replaces_by_both_keys(spark, extra):
    old = snapshot_rows(fact(spark, "high", "high"), DAY1)
    new = snapshot_rows(fact(spark, "medium"), DAY1).unionByName(
        snapshot_rows(fact(spark, "low"), DAY2)
    )
    if extra:
        new = new.withColumn("owner", F.lit("ops"))
    merged = delete_insert(old, new, SNAPSHOT_KEY)
    assert rows(merged, "snapshot_date", "break_key", "severity") == [
        (DAY1, 1, "medium"), (DAY1, 2, "high"), (DAY2, 1, "low"),
    ]
    if extra:
        assert merged.where("owner is null").count() == 1


def test_few_values_are_written_where_their_rows_are(spark, tmp_path):
    """Neither the fact by type nor a correction of few days is shuffled to be written."""
    fact = spark.range(400).selectExpr("id as break_key", "if(id % 2 = 0, 'a', 'b') as break_type").repartition(3)
    sources.write_fact(fact, str(tmp_path / "fact"))
    assert len(list(tmp_path.glob("fact/data/*/break_type=a/part-*"))) == 3
    history = str(tmp_path / "history")
    dated = "date_add(date'2025-01-01', cast(id % {} as int)) as snapshot_date"
    for days, files in ((2, 3), (20, 1)):
        new = spark.range(400).selectExpr("id as break_key", dated.format(days)).repartition(3)
        sources.correct_snapshot(spark, f"{history}{days}", new, ["snapshot_date", "break_key"])
        assert len(list(tmp_path.glob(f"history{days}/data/*/snapshot_date=2025-01-01/part-*"))) == files
        assert sources.read_snapshot(spark, f"{history}{days}").count() == 400
