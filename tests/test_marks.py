"""Breaks that travel as marks, and facts of several days from one sort."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tripartite import operators as op
from tripartite import plans
from tripartite.operators import numbering
from tripartite.schemas import FACT_COLUMNS, MARK_FIELDS
from tripartite.session import sized

from conftest import claims, contracts, payments, rows, sales

AS_OF = date(2025, 7, 1)


@pytest.fixture(scope="module")
def staged(spark):
    """Every type of break; unpaid sales on days before, on and after the limits of three
    days; repeated, missing and null keys, and measures that are null."""
    opened = [f"2025-06-{n:02}" for n in range(10, 24)]
    held = contracts(
        spark,
        *[(f"C{o[-2:]}{n}", f"S{o[-2:]}", "M1", o, "10.00", "50.00") for o in opened for n in range(2)],
        ("C1", "S1", "M1", "2025-05-01", "20.00", "100.00"), ("C2", "S404", "M2", "2025-06-25", "30.00", "10.00"),
        *[("C3", "S404", "M3", None, "5.00", "10.00")] * 2, (None, "S1", None, "2025-06-16", "9.00", "1.00"),
        ("C4", "S4", "M2", "2025-06-20", None, None),
    )
    sold = sales(
        spark,
        *[(f"S{o[-2:]}", "M1", o, "10.00", "10.00", None) for o in opened],
        ("S1", "M1", "2025-05-01", "20.00", "19.00", "2025-05-02"), ("S4", "M2", "2025-06-20", "5.00", None, None),
    )
    filed = claims(
        spark,
        ("K1", "C1", "V1", "2025-06-16", "80.00"), ("K1", "C3", "V0", "2025-06-30", "81.00"),
        *[("K2", "C404", "V1", "2025-06-17", "80.00")] * 2, ("K3", "C3", None, None, None),
        ("K4", None, "V1", "2025-06-17", "5.00"), (None, "C1", "V1", "2025-06-17", "5.00"),
        ("K5", "C2", "V2", "2025-06-18", "5.00"), ("K6", "C405", None, None, "7.00"),
    )
    made = payments(
        spark,
        ("R1", "K1", "V9", "2025-06-16", "60.00"), *[("R2", "K1", "V9", "2025-06-17", "90.00")] * 2,
        ("R3", "K2", "V9", None, "80.02"), ("R4", "K3", "V9", "2025-06-18", "30.00"),
        ("R5", "K4", "V9", "2025-06-18", None), ("R6", None, "V9", "2025-06-18", "30.00"),
        ("R7", "K5", "V9", "2025-06-18", "4.00"), (None, "K5", "V9", "2025-06-18", "50.00"),
    )
    return {
        "stg_contracts": held, "stg_merchant_sales": sold, "stg_claims": filed, "stg_servicer_reimbursements": made,
    }


def alone(staged, day):
    """The fact from breaks that travel whole."""
    return op.with_break_key(plans.build_breaks(staged, day))


def test_marks_tell_the_breaks(staged):
    fact = plans.build_fact(staged, AS_OF)
    assert fact.columns == FACT_COLUMNS and fact.dtypes == alone(staged, AS_OF).dtypes
    assert rows(fact) == rows(alone(staged, AS_OF))
    assert {r[0] for r in fact.select("break_type").distinct().collect()} == set(op.detect.DESCRIPTIONS)


def test_marks_only_are_written_and_sorted(spark, staged, tmp_path):
    plans.build_fact(staged, AS_OF, work=str(tmp_path)).count()
    for table in ("claim_breaks", "unordered", "ordered"):
        assert spark.read.parquet(str(tmp_path / table)).columns == list(MARK_FIELDS)
    # Breaks of claims are sorted from where they were found.
    rules = {r["rule"] for r in spark.read.parquet(str(tmp_path / "unordered")).collect()}
    assert rules == {0, 1, 2, 6}


def test_days_share_one_sort(staged, monkeypatch):
    sorts = []
    real = numbering.number_rows
    monkeypatch.setattr(numbering, "number_rows", lambda *given: sorts.append(given) or real(*given))
    # No sale became late between these days.
    days = [date(2025, 7, 20), date(2025, 7, 21)]
    facts = plans.build_facts(staged, days)
    assert len(sorts) == 1
    for day, fact in zip(days, facts, strict=True):
        assert rows(fact) == rows(alone(staged, day))


@pytest.mark.parametrize("sla_days", [14, 5])
def test_each_day_has_its_own_breaks_and_numbers(staged, sla_days):
    # Several sales a day become late between these; the last is not given last.
    days = [date(2025, 6, 30), date(2025, 7, 4), date(2025, 6, 25), date(2025, 7, 1)]
    facts = plans.build_facts(staged, days, sla_days)
    sizes = set()
    for day, fact in zip(days, facts, strict=True):
        assert rows(fact) == rows(op.with_break_key(plans.build_breaks(staged, day, sla_days)))
        keys = sorted(r["break_key"] for r in fact.collect())
        assert keys == list(range(1, len(keys) + 1))
        sizes.add(len(keys))
    assert len(sizes) > 1


def test_a_sort_is_cut_by_the_size_of_its_rows(spark, tmp_path, monkeypatch):
    asked = []
    monkeypatch.setattr(numbering, "sized", lambda session, size: asked.append(size) or sized(session, size))
    op.numbering.number_rows(spark.range(5000).select(F.lit("same").alias("x"), "id"), ["id"], "n", str(tmp_path))
    packed = sum(p.stat().st_size for p in (tmp_path / "unordered").glob("part-*"))
    assert asked[0] >= 8 * packed
