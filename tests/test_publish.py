"""Tables change at once or not at all."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tripartite import sources
from tripartite.schemas import FACT_SCHEMA
from tripartite.sources import publish, scratch

from conftest import rows
from test_snapshot import fact

DAY1, DAY2, DAY3 = date(2025, 7, 1), date(2025, 7, 2), date(2025, 7, 3)


def broken(df):
    """Fails in the middle of the rows that are being written."""
    return df.withColumn("description", F.when(F.col("break_key") == 2, F.raise_error(F.lit("lost"))).otherwise(F.col("description")))


def test_failed_rebuild_leaves_the_former_fact(spark, tmp_path):
    path = str(tmp_path / "fact")
    sources.write_fact(fact(spark, "high"), path)
    opened = sources.read_fact(spark, path)
    with pytest.raises(Exception, match="lost"):
        sources.write_fact(broken(fact(spark, "low", "low", "low")), path)
    assert rows(sources.read_fact(spark, path), "severity") == [("high",)] == rows(opened, "severity")
    assert len(list((tmp_path / "fact/data").iterdir())) == 1
    # Repeated, the rebuild succeeds; who has the former fact open can still read it.
    sources.write_fact(fact(spark, "low", "low"), path)
    assert rows(sources.read_fact(spark, path), "severity") == [("low",), ("low",)]
    assert rows(opened, "severity") == [("high",)]


def test_versions_before_the_last_two_are_removed(spark, tmp_path):
    path = str(tmp_path / "fact")
    for n in range(1, 6):
        sources.write_fact(fact(spark, *["high"] * n), path)
    assert sources.read_fact(spark, path).count() == 5
    assert len(list((tmp_path / "fact/data").iterdir())) == 2
    assert len(list((tmp_path / "fact/_commits").glob("*.json"))) == 2


def test_a_version_is_seen_when_it_is_published(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        sources.read_table(spark, path)
    version = publish.write_version(spark.range(3).toDF("x"), path)
    assert publish.current(spark, path) is None and version.read().count() == 3
    version.publish()
    assert sources.read_table(spark, path).count() == 3


def test_two_writers_from_one_state_conflict(spark, tmp_path):
    path = str(tmp_path / "t")
    sources.publish_table(spark.range(1).toDF("x"), path)
    before = publish.current(spark, path)
    mine, theirs = (publish.write_version(spark.range(n).toDF("x"), path) for n in (2, 3))
    publish.commit(spark, path, {"": theirs.folder}, theirs.schema, before)
    with pytest.raises(sources.PublishConflict):
        publish.commit(spark, path, {"": mine.folder}, mine.schema, before)
    assert sources.read_table(spark, path).count() == 3


def test_failed_day_leaves_the_history(spark, tmp_path):
    path = str(tmp_path / "history")
    sources.snapshot_breaks(fact(spark, "high"), path, DAY1)
    with pytest.raises(Exception, match="lost"):
        sources.snapshot_breaks(broken(fact(spark, "low", "low", "low")), path, DAY2)
    with pytest.raises(Exception, match="lost"):
        new = sources.snapshot_rows(broken(fact(spark, "low", "low", "low")), DAY1)
        sources.correct_snapshot(spark, path, new, ["snapshot_date", "break_key"])
    assert rows(sources.read_snapshot(spark, path), "snapshot_date", "severity") == [(DAY1, "high")]
    assert sources.snapshot_breaks(fact(spark, "low"), path, DAY2)
    assert rows(sources.captured_dates(spark, path)) == [(DAY1,), (DAY2,)]


def test_correction_reads_and_writes_its_days_alone(spark, tmp_path):
    path = str(tmp_path / "history")
    for day in (DAY1, DAY2, DAY3):
        sources.snapshot_breaks(fact(spark, "high", "high"), path, day)
    before = publish.current(spark, path).parts
    new = sources.snapshot_rows(fact(spark, "low"), DAY2).withColumn("owner", F.lit("ops"))
    sources.correct_snapshot(spark, path, new, ["snapshot_date", "break_key"])
    after = publish.current(spark, path).parts
    assert [d for d in before if before[d] != after[d]] == ["2025-07-02"]
    found = rows(sources.read_snapshot(spark, path).where("snapshot_date = date'2025-07-02'"), "break_key", "severity", "owner")
    assert found == [(1, "low", "ops"), (2, "high", None)]
    assert sources.read_snapshot(spark, path).count() == 6


def test_opening_a_long_history_reads_no_footers(spark, tmp_path):
    path = str(tmp_path / "history")
    sources.snapshot_breaks(fact(spark, "high"), path, DAY1)
    sources.snapshot_breaks(fact(spark, "low").withColumn("owner", F.lit("ops")), path, DAY2)
    group, context = "opening", spark.sparkContext
    context.setJobGroup(group, group)
    try:
        history = sources.read_snapshot(spark, path)
        assert not context.statusTracker().getJobIdsForGroup(group)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert history.columns[-1] == "owner" and history.count() == 2


def test_a_column_keeps_its_type(spark, tmp_path):
    path = str(tmp_path / "history")
    sources.snapshot_breaks(fact(spark, "high"), path, DAY1)
    with pytest.raises(ValueError, match="days_open"):
        sources.snapshot_breaks(fact(spark, "high").withColumn("days_open", F.lit("x")), path, DAY2)
    assert sources.read_snapshot(spark, path).count() == 1


def test_rows_without_a_day_stop_the_history(spark, tmp_path):
    """NOT IN with a null among the captured days is never true."""
    path = str(tmp_path / "history")
    sources.snapshot_breaks(fact(spark, "high"), path, DAY1)
    undated = sources.snapshot_rows(fact(spark, "low"), DAY1).withColumn("snapshot_date", F.lit(None).cast("date"))
    sources.correct_snapshot(spark, path, undated, ["snapshot_date", "break_key"])
    assert rows(sources.captured_dates(spark, path)) == sorted([(DAY1,), (None,)], key=repr)
    assert not sources.snapshot_breaks(fact(spark, "low"), path, DAY2)
    both = sources.snapshot_rows(fact(spark, "low"), DAY2)
    left = sources.not_captured(both, sources.captured_dates(spark, path))
    assert left.isEmpty()
    assert "LeftAnti" in left._jdf.queryExecution().executedPlan().toString()
    # A full refresh does not ask.
    assert sources.snapshot_breaks(fact(spark, "low"), path, DAY2, full_refresh=True)
    assert rows(sources.read_snapshot(spark, path), "snapshot_date") == [(DAY2,)]


def test_not_captured(spark):
    days = spark.createDataFrame([(DAY1,), (DAY2,), (None,)], "snapshot_date date")
    none, one = days.where("false"), days.where(F.col("snapshot_date") == F.lit(DAY1))
    assert rows(sources.not_captured(days, one)) == [(DAY2,)]
    assert len(rows(sources.not_captured(days, none))) == 3
    assert rows(sources.not_captured(days, days)) == []


def test_a_day_without_breaks_can_be_captured_again(spark, tmp_path):
    path = str(tmp_path / "history")
    empty = spark.createDataFrame([], FACT_SCHEMA)
    assert sources.read_snapshot(spark, path).isEmpty()
    sources.snapshot_breaks(empty, path, DAY1)
    assert sources.read_snapshot(spark, path).isEmpty()
    assert sources.snapshot_breaks(fact(spark, "high"), path, DAY1)
    assert sources.read_snapshot(spark, path).count() == 1


def test_workspace_goes_at_its_end(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(scratch, "shared_dir", lambda spark: str(tmp_path))
    with sources.workspace(spark) as root:
        kept = sources.write_all({"a": spark.range(3), "b": spark.range(4)})
        assert [df.count() for df in kept.values()] == [3, 4]
        assert all(root in df.inputFiles()[0] for df in kept.values())
    assert not list((tmp_path / "tripartite").iterdir())


def test_versions_are_packed(spark, tmp_path):
    publish.publish_table(spark.range(3).toDF("x"), str(tmp_path / "t"))
    files = list(tmp_path.glob("t/data/*/part-*"))
    assert files and all(f.name.endswith(".zstd.parquet") for f in files)
