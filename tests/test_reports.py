from datetime import date
from decimal import Decimal

import pytest

from tripartite import operators as op
from tripartite import plans, sources

import feeds
from conftest import AS_OF, rows


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    raw = sources.read_raw_sources(spark, feeds.write(tmp_path_factory.mktemp("feeds")))
    staged = op.stage_all(raw)
    fact = plans.build_fact(staged, AS_OF).cache()
    yield raw, staged, fact
    fact.unpersist()


def test_detected_counts(built):
    assert dict(rows(plans.detected_counts(built[2]))) == feeds.EXPECTED


def test_keys_are_dense(built):
    keys = [r[0] for r in rows(built[2], "break_key")]
    assert sorted(keys) == list(range(1, sum(feeds.EXPECTED.values()) + 1))


def test_break_aging_order_and_totals(built):
    aging = plans.break_aging(built[2])
    found = [(r["severity"], r["break_type"], r["break_count"]) for r in aging.collect()]
    assert found == [
        ("high", "coverage_exceeded", 1),
        ("high", "duplicate_claim", 1),
        ("high", "orphan_claim", 1),
        ("high", "orphan_contract", 1),
        ("high", "timing_break", 2),
        ("medium", "amount_break", 3),
        ("medium", "overpayment", 1),
    ]
    by_label = plans.aging_report(aging).collect()
    assert [r["severity"] for r in by_label] == sorted(r["severity"] for r in by_label)


def test_kpis(built):
    kpi = plans.kpi_summary(built[2]).first()
    assert (kpi["total_breaks"], kpi["high_severity"]) == (10, 6)
    # C4 24, C1 and C2 twice (21 and 22), C3 5, K10 100, K5 600, R6 30.01, C5 200.
    assert kpi["total_amount_at_risk"] == Decimal("1045.01")


def test_scorecard_keeps_idle_merchants(built):
    raw, staged, fact = built
    card = plans.merchant_scorecard(fact, raw["merchants"], staged["stg_contracts"]).collect()
    assert [r["merchant_id"] for r in card] == ["M2", "M1", "M3"]
    idle = card[2].asDict()
    assert idle["total_contracts"] == idle["total_breaks"] == 0
    assert idle["break_rate"] == 0.0
    assert idle["total_premium_expected"] == Decimal("0.00")
    busy = card[0].asDict()
    # Odd contracts: C1 (timing, amount), C3 (amount), C5 (coverage, in no column of its own).
    assert (busy["total_breaks"], busy["timing_breaks"], busy["amount_breaks"]) == (4, 1, 2)
    assert busy["break_rate"] == round(4 / 15, 3)


def test_drilldown(built):
    fact = built[2]
    found = plans.break_drilldown(fact, ["timing_break", "overpayment"], ["high", "medium"])
    assert [(r["break_type"], r["entity_id"], r["counterparty"]) for r in found.collect()] == [
        ("timing_break", "C1", "M2"), ("timing_break", "C2", "M1"), ("overpayment", "R6", "V1"),
    ]
    assert plans.break_drilldown(fact, [], ["high"]).isEmpty()
    assert plans.break_drilldown(fact, ["timing_break"], []).isEmpty()


def test_filter_values(built):
    found = plans.break_filter_values(built[2]).collect()
    assert [r["value"] for r in found if r["filter"] == "break_type"] == sorted(feeds.EXPECTED)
    assert [r["value"] for r in found if r["filter"] == "severity"] == ["high", "medium"]


def test_break_report_and_type_summary(built):
    fact = built[2]
    report = plans.break_report(fact, "M2", AS_OF, ["amount_break", "timing_break"])
    assert rows(report, "break_type", "entity_id") == [
        ("amount_break", "C1"), ("amount_break", "C3"), ("timing_break", "C1"),
    ]
    assert plans.break_report(fact, "M2", date(2025, 6, 30), ["amount_break"]).isEmpty()
    summary = plans.break_type_summary(fact, limit=2).collect()
    assert [(r["break_type"], r["breaks"]) for r in summary] == [
        ("amount_break", 3), ("coverage_exceeded", 1),
    ]


def test_lookups(built):
    staged = built[1]
    sold = plans.merchant_sales_range(
        staged["stg_merchant_sales"], "M1", date(2025, 3, 1), date(2025, 3, 1)
    )
    assert sold.count() == 14
    detail = plans.contract_detail(staged["stg_contracts"], staged["stg_merchant_sales"], "C1")
    assert rows(detail, "contract_id", "is_unpaid") == [("C1", True)]
    assert plans.servicer_claims(staged["stg_claims"], "V2").count() == 5
    assert plans.servicer_claims(staged["stg_claims"], "V2", "denied").isEmpty()


def test_truth_validation(spark, built):
    fact = built[2]
    truth = spark.createDataFrame(
        [("amount_break",)] * 2 + [("orphan_claim",)] * 2 + [("unknown",)], "break_type string"
    )
    found = {r["break_type"]: r for r in plans.truth_validation(fact, truth).collect()}
    assert len(found) == 8
    assert tuple(found["amount_break"]) == ("amount_break", 2, 3, "150%")
    assert tuple(found["orphan_claim"]) == ("orphan_claim", 2, 1, "50%")
    assert tuple(found["overpayment"]) == ("overpayment", 0, 1, "N/A")
    assert tuple(found["unknown"]) == ("unknown", 1, 0, "0%")
    lost = plans.truth_regressions(fact, truth)
    assert rows(lost, "break_type") == [("orphan_claim",), ("unknown",)]
    assert tuple(plans.truth_log_totals(truth).first()) == (5, 3)
