import re
from datetime import date

import pytest

from tripartite import operators as op
from tripartite import plans, sources
from tripartite.plans import quality
from tripartite.schemas import FACT_FIELDS

import feeds
from conftest import AS_OF, conf, rows

DAY1, DAY2 = date(2025, 7, 1), date(2025, 7, 2)


def raw_feeds(spark, folder, change=None):
    data = feeds.build()
    if change:
        change(data)
    folder.mkdir(exist_ok=True)
    return sources.read_raw_sources(spark, feeds.write(folder, data))


def test_full_run_passes_all_checks_and_keeps_history(spark, tmp_path):
    raw = raw_feeds(spark, tmp_path / "feeds")
    out = str(tmp_path / "out")
    run = plans.run_pipeline(raw, out, AS_OF, snapshot_date=DAY1)
    assert run.checks == {"pass": 48}
    assert run.snapshot_written
    assert dict(rows(plans.detected_counts(run.tables["fct_recon_breaks"]))) == feeds.EXPECTED
    for name in ("break_aging", "merchant_scorecard", "fct_recon_breaks"):
        assert sources.read_table(spark, f"{out}/{name}").count() == run.tables[name].count()
    # Again on the same day, then on the next.
    assert not plans.run_pipeline(raw, out, AS_OF, snapshot_date=DAY1).snapshot_written
    again = plans.run_pipeline(raw, out, AS_OF, snapshot_date=DAY2)
    history = again.tables["fct_daily_break_snapshot"]
    assert rows(history.groupBy("snapshot_date").count()) == [(DAY1, 10), (DAY2, 10)]


def test_repeated_key_stops_the_run_before_anything_is_built(spark, tmp_path):
    raw = raw_feeds(
        spark, tmp_path / "feeds", lambda f: f["contracts"].append(f["contracts"][0])
    )
    with pytest.raises(plans.QualityError, match="unique_contracts_contract_id"):
        plans.run_pipeline(raw, str(tmp_path / "out"), AS_OF, snapshot_date=DAY1)
    assert [p.name for p in (tmp_path / "out").iterdir()] == ["work"]
    assert not list((tmp_path / "out/work").iterdir())


def test_failing_check_is_raised_once_and_can_be_reported_instead(spark, tmp_path, monkeypatch):
    """A single payment above the limit breaks the invariant; the run is not repeated."""
    raw = raw_feeds(
        spark, tmp_path / "feeds",
        lambda f: f["servicer_reimbursements"].append("R99,K7,V1,2025-04-20,1000.01"),
    )
    attempts = []
    original = quality.over_coverage
    monkeypatch.setattr(quality, "over_coverage", lambda *t: attempts.append(1) or original(*t))
    with pytest.raises(plans.QualityError, match="reimbursement_never_exceeds_coverage"):
        plans.run_pipeline(raw, str(tmp_path / "out"), AS_OF, snapshot_date=DAY1)
    assert len(attempts) == 1
    # Neither a commit nor a version that was not published is left.
    assert not list((tmp_path / "out").rglob("*.json")) and not list((tmp_path / "out").rglob("*.parquet"))
    run = plans.run_pipeline(raw, str(tmp_path / "out2"), AS_OF, snapshot_date=DAY1, gate=False)
    assert run.checks == {"pass": 47, "fail": 1}


def test_check_functions_return_the_violations(spark):
    df = spark.createDataFrame(
        [("a", 1), ("a", 2), (None, 3), (None, 4), ("b", None)], "k string, v int"
    )
    assert rows(plans.not_null(df, "k", "v")) == [("k", 2), ("v", 1)]
    assert rows(plans.unique(df, "k")) == [("a", 2)]
    assert rows(plans.accepted_values(df, "k", ["a"])) == [("b", 1)]
    parents = spark.createDataFrame([("a",), (None,)], "id string")
    assert rows(plans.relationships(df, parents, "k", "id")) == [("b", None)]


def test_coverage_invariant_rows(spark, tmp_path):
    raw = raw_feeds(
        spark, tmp_path / "feeds",
        lambda f: f["servicer_reimbursements"].append("R99,K7,V1,2025-04-20,1000.01"),
    )
    staged = op.stage_all(raw)
    found = plans.reimbursement_within_coverage(
        staged["stg_servicer_reimbursements"], staged["stg_claims"], staged["stg_contracts"]
    )
    assert rows(found, "reimbursement_id", "contract_id") == [("R99", "C7")]


def test_declared_checks_are_48(spark, tmp_path):
    raw = raw_feeds(spark, tmp_path / "feeds")
    declared = (
        sum(len(c) for c in quality.REQUIRED.values()), len(quality.UNIQUE),
        len(quality.ACCEPTED), len(quality.FOREIGN_KEYS),
    )
    assert declared == (31, 11, 4, 1)
    results = plans.run_checks(raw)
    assert results.columns == ["check", "status", "failures"]
    assert rows(plans.dq_summary(results)) == [("pass", 14)]


OVER_LIMIT = "R99,K7,V1,2025-04-20,1000.01"


def test_failing_gate_leaves_what_is_published(spark, tmp_path):
    out = tmp_path / "out"
    good = raw_feeds(spark, tmp_path / "good")
    plans.run_pipeline(good, str(out), AS_OF, snapshot_date=DAY1).close(spark)
    bad = raw_feeds(
        spark, tmp_path / "bad", lambda f: f["servicer_reimbursements"].append(OVER_LIMIT)
    )
    with pytest.raises(plans.QualityError):
        plans.run_pipeline(bad, str(out), AS_OF, snapshot_date=DAY2)
    history = sources.read_snapshot(spark, str(out / "fct_daily_break_snapshot"))
    assert rows(history.groupBy("snapshot_date").count()) == [(DAY1, 10)]
    assert sources.read_fact(spark, str(out / "fct_recon_breaks")).count() == 10
    # Put right, the day can still be captured.
    assert plans.run_pipeline(good, str(out), AS_OF, snapshot_date=DAY2).snapshot_written


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_rebuild_drops_types_that_no_longer_occur(spark, tmp_path, mode):
    with conf(spark, {"spark.sql.sources.partitionOverwriteMode": mode}):
        out = str(tmp_path / "out")
        first = plans.run_pipeline(raw_feeds(spark, tmp_path / "a"), out, AS_OF, snapshot_date=DAY1)
        again = raw_feeds(
            spark, tmp_path / "b", lambda f: f["servicer_reimbursements"].pop()
        )
        second = plans.run_pipeline(again, out, AS_OF, snapshot_date=DAY2)
        found = dict(rows(plans.detected_counts(second.tables["fct_recon_breaks"])))
        assert "duplicate_claim" not in found and "coverage_exceeded" not in found
        # The first run's intermediate frames are its own.
        assert first.tables["int_claim_lifecycle"].count() == 11
        assert second.tables["int_claim_lifecycle"].count() == 10


def test_feeds_are_parsed_once(spark, tmp_path, monkeypatch):
    raw = raw_feeds(spark, tmp_path / "feeds")
    planned = []
    original = quality.run_checks

    def keep(*args, **named):
        result = original(*args, **named)
        planned.append(result._jdf.queryExecution().executedPlan().toString())
        return result

    monkeypatch.setattr(quality, "run_checks", keep)
    run = plans.run_pipeline(raw, str(tmp_path / "out"), AS_OF, snapshot_date=DAY1)
    assert len(planned) == 2 and all("FileScan csv" not in p for p in planned)
    # Nulls and listed values were counted while the tables were written: what is read are
    # the keys, and the payments with their limits.
    reads = [c for p in planned for c in re.findall(r"ReadSchema: struct<(.*?)>", p)]
    fields = {c.split(":")[0] for read in reads for c in read.split(",") if ":" in c}
    assert "premium" not in fields and "severity" not in fields and "product_price" not in fields
    assert all("count_if" not in p and "isnull(break_type" not in p for p in planned)
    lifecycle = run.tables["int_contract_lifecycle"]._jdf.queryExecution().executedPlan().toString()
    assert "FileScan csv" not in lifecycle and "Exchange" not in lifecycle.replace("BroadcastExchange", "")


def test_settings_are_as_before(spark, tmp_path):
    width = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    raw = raw_feeds(spark, tmp_path / "feeds")
    for given in (None, "3"):
        with conf(spark, {"spark.sql.session.timeZone": "Asia/Tokyo", width: "3"}):
            if given is None:
                spark.conf.unset(width)
            plans.run_pipeline(raw, str(tmp_path / f"out{given}"), AS_OF, snapshot_date=DAY1)
            assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
            assert spark.conf.get(width, None) == given


def test_null_and_unlisted_values_are_counted_while_writing(spark, tmp_path):
    bad = raw_feeds(spark, tmp_path / "feeds", lambda f: f["contracts"].extend([",S1,M1,2025-03-01,1.0,1.0,12,x", "C99,,M1,2025-03-01,,1.0,12,x"]))
    landed = plans.land_feeds(bad, str(tmp_path / "landed"))
    counted = {c: n for c, n in plans.feed_counts(landed).items() if n}
    assert counted == {
        "not_null_contracts_contract_id": 1, "not_null_stg_contracts_contract_id": 1,
        "not_null_stg_contracts_sale_id": 1, "not_null_stg_contracts_premium": 1,
    }
    raw = {n: f.rows for n, f in landed.items()}
    tables = raw | op.stage_all(raw)
    assert rows(plans.run_checks(tables, counted=plans.feed_counts(landed))) == rows(plans.run_checks(tables))
    fact = spark.createDataFrame([("no_break", "high"), ("no_break", None), ("other", "low"), ("overpayment", "low")], "break_type string, severity string")
    full = fact.selectExpr(*[c if c in fact.columns else f"cast(null as {k}) as {c}" for c, k in FACT_FIELDS.items()])
    version, counted = plans.stage_counted(full, str(tmp_path / "fact"), DAY1)
    assert counted["accepted_values_fct_recon_breaks_break_type"] == 3
    marts = {"fct_recon_breaks": version.read(), "fct_daily_break_snapshot": sources.snapshot_rows(version.read(), DAY1)}
    assert rows(plans.run_checks(marts, counted=counted)) == rows(plans.run_checks(marts))


def test_reports_from_the_rollup_equal_those_from_the_fact(spark, tmp_path):
    run = plans.run_pipeline(raw_feeds(spark, tmp_path / "feeds"), str(tmp_path / "out"), AS_OF, snapshot_date=DAY1)
    undated = run.tables["fct_recon_breaks"].selectExpr("* except (opened_at, days_open, merchant_id)", "cast(null as date) opened_at", "cast(null as int) days_open", "merchant_id")
    for fact in (run.tables["fct_recon_breaks"], undated, undated.where("false")):
        rollup = plans.break_rollup(fact)
        for report in ("break_aging", "kpi_summary", "break_type_summary", "break_filter_values", "merchant_breaks", "detected_counts"):
            from_fact, from_rollup = getattr(plans, report)(fact), getattr(plans, report)(rollup)
            assert from_fact.dtypes == from_rollup.dtypes
            assert rows(from_fact) == rows(from_rollup)


def test_truth_gate(spark, tmp_path):
    raw = raw_feeds(spark, tmp_path / "feeds")
    truth = spark.createDataFrame([("orphan_claim",), ("overpayment",), ("overpayment",)], "break_type string")
    run = plans.run_pipeline(raw, str(tmp_path / "a"), AS_OF, DAY1, gate=False, truth=truth)
    assert [(r.break_type, r.planted, r.detected) for r in run.regressions] == [("overpayment", 2, 1)]
    assert run.seconds > 0
    with pytest.raises(plans.QualityError, match=r"overpayment \(1 of 2\)"):
        plans.run_pipeline(raw, str(tmp_path / "b"), AS_OF, DAY1, truth=truth)


def test_history_shows_columns_of_earlier_days(spark, tmp_path):
    raw = raw_feeds(spark, tmp_path / "feeds")
    out = str(tmp_path / "out")
    first = plans.run_pipeline(raw, out, AS_OF, snapshot_date=DAY1)
    wider = first.tables["fct_recon_breaks"].selectExpr("*", "'x' as note")
    sources.snapshot_breaks(wider, f"{out}/fct_daily_break_snapshot", date(2025, 6, 30))
    history = plans.run_pipeline(raw, out, AS_OF, snapshot_date=DAY2).tables["fct_daily_break_snapshot"]
    assert history.where("note = 'x'").count() == 10


def test_check_functions_take_any_column_name(spark):
    df = spark.createDataFrame([("a", 1), ("a", None)], "`order id` string, `a.b` int")
    assert rows(plans.unique(df, "order id")) == [("a", 2)]
    assert rows(plans.not_null(df, "a.b")) == [("a.b", 1)]
    assert rows(plans.accepted_values(df, "order id", ["b"])) == [("a", 2)]
    assert plans.relationships(df, df, "order id", "order id").isEmpty()
