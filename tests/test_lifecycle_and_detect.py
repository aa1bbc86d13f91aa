"""Edge rows for the joins and the seven detectors."""

from datetime import date
from decimal import Decimal

import pytest

from tripartite import operators as op
from tripartite.schemas import BREAK_FIELDS

from conftest import AS_OF, claims, contracts, payments, rows, sales


def contract(spark, premium="50.00", remitted="50.00", paid="2025-06-05", issued="2025-06-01"):
    """Lifecycle of one contract with a sale."""
    return op.contract_lifecycle(
        contracts(spark, ("C1", "S1", "M1", issued, premium, "500.00")),
        sales(spark, ("S1", "M1", issued, premium, remitted, paid)),
    )


def claim(spark, amount, *paid, limit="1000.00", contract_id="C1"):
    """Contract and claim lifecycle of one claim with the given payments."""
    held = contracts(spark, ("C1", "S1", "M1", "2025-01-01", "50.00", limit))
    sold = sales(spark, ("S1", "M1", "2025-01-01", "50.00", "50.00", "2025-01-02"))
    filed = claims(spark, ("K1", contract_id, "V1", "2025-03-01", amount))
    made = payments(
        spark, *[(f"R{i}", "K1", "V9", "2025-03-20", p) for i, p in enumerate(paid, 1)]
    )
    return op.contract_lifecycle(held, sold), op.claim_lifecycle(filed, made, held)


def types(df):
    return [r["break_type"] for r in df.collect()]


def test_staging_types_and_dirty_dates(spark):
    raw = spark.createDataFrame(
        [("S1", "M1", "2025-01-01", "100", "9.999", "0.0", "", "x@example.com"),
         ("S2", "M1", "2025-01-01", "100", "10", "10", "bad", None),
         ("S3", "M1", "2025-01-01", "100", "10", "10", "2025-01-09", None)],
        "sale_id string, merchant_id string, sale_date string, product_price string,"
        " premium_charged string, remittance_amount string, remittance_date string,"
        " customer_email string",
    )
    staged = op.stage_merchant_sales(raw)
    assert staged.columns == [
        "sale_id", "merchant_id", "sale_date", "product_price", "premium_charged",
        "remittance_amount", "remittance_date_raw", "remittance_date", "customer_email",
    ]
    assert rows(staged, "sale_id", "premium_charged", "remittance_date_raw", "remittance_date") == [
        ("S1", Decimal("10.00"), None, None),
        ("S2", Decimal("10.00"), "bad", None),
        ("S3", Decimal("10.00"), "2025-01-09", date(2025, 1, 9)),
    ]


@pytest.mark.parametrize(("remitted", "found"), [("50.01", []), ("50.02", ["amount_break"])])
def test_amount_tolerance(spark, remitted, found):
    assert types(op.detect_amount_break(contract(spark, remitted=remitted))) == found


@pytest.mark.parametrize(("paid", "found"), [("80.01", []), ("80.02", ["overpayment"])])
def test_overpayment_tolerance(spark, paid, found):
    _, lifecycle = claim(spark, "80.00", paid)
    assert types(op.detect_overpayment(lifecycle)) == found


@pytest.mark.parametrize(("second", "found"), [("40.00", []), ("40.01", ["coverage_exceeded"])])
def test_coverage_has_no_tolerance(spark, second, found):
    both = claim(spark, "100.00", "60.00", second, limit="100.00")
    assert types(op.detect_coverage_exceeded(*both)) == found


@pytest.mark.parametrize(
    ("issued", "found"),
    [("2025-06-17", []), ("2025-06-16", [("timing_break", "medium")]),
     ("2025-06-01", [("timing_break", "medium")]), ("2025-05-31", [("timing_break", "high")])],
)
def test_sla_edges(spark, issued, found):
    """Unpaid for 14, 15, 30 and 31 days."""
    unpaid = contract(spark, remitted="0.00", paid=None, issued=issued)
    assert rows(op.detect_timing_break(unpaid, AS_OF), "break_type", "severity") == found


def test_thresholds_are_parameters(spark):
    unpaid = contract(spark, remitted="0.00", paid=None, issued="2025-06-17")
    found = op.detect_timing_break(unpaid, AS_OF, sla_days=10, high_after_days=12)
    assert rows(found, "severity", "description") == [
        ("high", "Merchant has not remitted premium within 10 days of contract issuance.")
    ]


def test_late_but_paid_is_no_timing_break(spark):
    paid = contract(spark, issued="2025-05-01", paid="2025-06-10")
    assert types(op.detect_timing_break(paid, AS_OF)) == []


def test_missing_amount_has_no_description(spark):
    unpaid = contract(spark, remitted=None, paid=None)
    assert rows(op.detect_amount_break(unpaid), "amount_at_risk", "description") == [
        (Decimal("50.00"), None)
    ]


def test_orphan_contract_flags_are_null(spark):
    lone = op.contract_lifecycle(
        contracts(spark, ("C1", "S9", "M1", "2025-01-01", "50.00", "500.00")),
        sales(spark, ("S1", "M1", "2025-01-01", "50.00", "50.00", "2025-01-02")),
    )
    assert rows(lone, "is_orphan_contract", "is_unpaid", "has_amount_break") == [
        (True, None, None)
    ]
    assert types(op.contract_breaks(lone, AS_OF)) == ["orphan_contract"]


def test_contract_without_sale_id_is_an_orphan(spark):
    lone = op.contract_lifecycle(
        contracts(spark, ("C1", None, "M1", "2025-01-01", "50.00", "500.00")),
        sales(spark, (None, "M1", "2025-01-01", "50.00", "50.00", "2025-01-02")),
    )
    assert types(op.detect_orphan_contract(lone)) == ["orphan_contract"]


def test_paid_orphan_claim(spark):
    both = claim(spark, "80.00", "80.00", "80.00", contract_id="C404", limit="1.00")
    found = op.claim_breaks(both[1], both[0])
    assert sorted(types(found)) == ["duplicate_claim", "orphan_claim"]


def test_one_read_of_the_claims_finds_what_the_rules_find(spark):
    """Repeated and null ids, copies of payments and claims, terms that are repeated."""
    held = contracts(
        spark,
        ("C1", "S1", "M1", "2025-01-01", "50.00", "100.00"), ("C2", "S2", "M1", "2025-01-01", "50.00", None),
        ("C3", "S3", "M2", "2025-01-01", "50.00", "10.00"), ("C3", "S4", "M3", "2025-01-02", "50.00", "20.00"),
        (None, "S5", "M1", "2025-01-01", "50.00", "1.00"),
    )
    filed = claims(
        spark,
        ("K1", "C1", "V1", "2025-03-01", "80.00"), ("K1", "C3", "V0", "2025-03-02", "81.00"),
        ("K2", "C404", "V1", "2025-03-01", "80.00"), ("K2", "C404", "V1", "2025-03-01", "80.00"),
        ("K3", "C3", None, None, None), ("K4", None, "V1", "2025-03-01", "5.00"), (None, "C1", "V1", "2025-03-01", "5.00"),
        ("K5", "C2", "V1", "2025-03-01", "5.00"),
    )
    made = payments(
        spark,
        ("R1", "K1", "V9", "2025-03-20", "60.00"), ("R2", "K1", "V9", "2025-03-20", "90.00"),
        ("R2", "K1", "V9", "2025-03-20", "90.00"), ("R3", "K2", "V9", "2025-03-20", "80.02"),
        ("R4", "K3", "V9", "2025-03-20", "30.00"), ("R5", "K4", "V9", "2025-03-20", None),
        ("R6", None, "V9", "2025-03-20", "30.00"), ("R7", "K5", "V9", None, "30.00"),
    )
    sold = sales(spark, ("S1", "M1", "2025-01-01", "50.00", "50.00", "2025-01-02"))
    contract, claim_rows = op.contract_lifecycle(held, sold), op.claim_lifecycle(filed, made, held)
    apart = (
        op.detect_orphan_claim(claim_rows)
        .unionByName(op.detect_duplicate_claim(claim_rows))
        .unionByName(op.detect_overpayment(claim_rows))
        .unionByName(op.detect_coverage_exceeded(contract, claim_rows))
    )
    together = op.claim_breaks(claim_rows, contract)
    assert together.schema == apart.schema
    assert rows(together) == rows(apart)
    assert len(rows(apart)) > 8
    # Without the orphans: payments with their claims alone.
    paid = op.paid_claims(filed, made)
    assert rows(op.claim_breaks(paid, op.contract_terms(held))) == rows(
        op.detect_duplicate_claim(paid)
        .unionByName(op.detect_overpayment(paid))
        .unionByName(op.detect_coverage_exceeded(op.contract_terms(held), paid))
    )


def test_claims_that_lie_by_claim_give_the_same_breaks(spark):
    """Repeated and null ids, copies of payments, claims and terms, payments on a contract
    under several claims."""
    held = contracts(
        spark,
        *[("C1", "S1", "M1", "2025-01-01", "50.00", "100.00")] * 2, ("C2", "S2", "M1", "2025-01-01", "50.00", None),
        ("C3", "S3", "M2", "2025-01-01", "50.00", "10.00"), ("C3", "S4", "M3", "2025-01-02", "50.00", "20.00"),
        (None, "S5", "M1", "2025-01-01", "50.00", "1.00"),
    )
    filed = claims(
        spark,
        ("K1", "C1", "V1", "2025-03-01", "80.00"), ("K1", "C3", "V0", "2025-03-02", "81.00"),
        *[("K2", "C404", "V1", "2025-03-01", "80.00")] * 2, ("K3", "C3", None, None, None),
        ("K4", None, "V1", "2025-03-01", "5.00"), (None, "C1", "V1", "2025-03-01", "5.00"),
        ("K5", "C1", "V1", "2025-03-01", "5.00"), ("K6", "C2", "V2", "2025-03-01", "5.00"),
    )
    made = payments(
        spark,
        ("R1", "K1", "V9", "2025-03-20", "60.00"), *[("R2", "K1", "V9", "2025-03-20", "90.00")] * 2,
        ("R3", "K2", "V9", "2025-03-20", "80.02"), ("R4", "K3", "V9", "2025-03-20", "30.00"),
        ("R5", "K4", "V9", "2025-03-20", None), ("R6", None, "V9", "2025-03-20", "30.00"),
        ("R7", "K5", "V9", None, "50.00"), ("R8", "K6", "V9", "2025-03-20", None), ("R9", "K6", "V9", None, None),
    )
    terms = op.contract_terms(held)
    for read in (op.paid_claims(filed, made), op.claim_lifecycle(filed, made, held)):
        found = op.claim_breaks(read, terms, dealt=True)
        assert found.schema == op.claim_breaks(read, terms).schema
        assert rows(found) == rows(op.claim_breaks(read, terms))
        assert len(rows(found.where("break_type = 'coverage_exceeded'"))) == 4


def test_orphan_claim_needs_no_payments(spark):
    filed = claims(spark, ("K1", "C404", "V1", "2025-03-01", "80.00"), ("K2", None, "V1", "2025-03-01", "5.00"))
    held = contracts(spark, ("C1", "S1", "M1", "2025-01-01", "50.00", "500.00"))
    found = op.detect_orphan_claim(op.claims_with_contract(filed, held))
    assert rows(found, "entity_id") == [("K1",), ("K2",)]


def test_duplicate_below_the_claim_is_negative(spark):
    _, lifecycle = claim(spark, "80.00", "30.00", "40.00")
    assert rows(op.detect_duplicate_claim(lifecycle), "amount_at_risk", "description") == [
        (Decimal("-10.00"), "Claim reimbursed 2 times, total paid = 70.00")
    ]


def test_overpayment_names_the_servicer_of_the_claim(spark):
    _, lifecycle = claim(spark, "80.00", "100.00")
    assert rows(op.detect_overpayment(lifecycle), "entity_id", "servicer_id", "merchant_id") == [
        ("R1", "V1", None)
    ]


def test_claim_lifecycle_rows(spark):
    filed = claims(
        spark,
        ("K1", "C1", "V1", "2025-03-01", "80.00"),
        ("K2", "C1", "V1", "2025-03-01", "80.00"),
        ("K3", "C404", "V1", "2025-03-01", "80.00"),
    )
    made = payments(
        spark,
        ("R1", "K1", "V1", "2025-03-20", "80.00"),
        ("R2", "K1", "V1", "2025-03-21", "90.00"),
        ("R3", "K3", "V1", "2025-03-21", None),
        ("R4", "K404", "V1", "2025-03-21", "5.00"),
    )
    held = contracts(spark, ("C1", "S1", "M1", "2025-01-01", "50.00", "500.00"))
    lifecycle = op.claim_lifecycle(filed, made, held)
    found = rows(
        lifecycle, "claim_id", "reimbursement_id", "matched_contract_id",
        "is_orphan_claim", "is_unpaid_claim", "is_overpayment",
    )
    assert found == [
        ("K1", "R1", "C1", False, False, False),
        ("K1", "R2", "C1", False, False, True),
        ("K2", None, "C1", False, True, None),
        ("K3", "R3", None, True, False, None),
    ]


def test_payment_without_a_claim_id_meets_no_claim(spark):
    filed = claims(spark, ("K1", "C1", "V1", "2025-03-01", "80.00"))
    made = payments(spark, ("R1", None, "V1", "2025-03-20", "80.00"))
    held = contracts(spark, ("C1", "S1", "M1", "2025-01-01", "50.00", "500.00"))
    assert rows(op.claim_lifecycle(filed, made, held), "claim_id", "is_unpaid_claim") == [
        ("K1", True)
    ]


def test_one_pass_equals_the_single_detectors(spark):
    """Every contract rule at once against one detector after the other."""
    held = contracts(
        spark,
        *[(f"C{i}", f"S{i}", f"M{i % 2}", "2025-05-01", "50.00", "90.00") for i in range(40)],
    )
    sold = sales(
        spark,
        *[
            (f"S{i}", f"M{i % 2}", "2025-05-01", "50.00", "0.00" if i % 5 == 0 else f"{50 - i % 3}.00",
             None if i % 5 == 0 else "2025-05-03")
            for i in range(40) if i % 7
        ],
    )
    lifecycle = op.contract_lifecycle(held, sold)
    one_pass = op.contract_breaks(lifecycle, AS_OF)
    separate = (
        op.detect_orphan_contract(lifecycle)
        .unionByName(op.detect_timing_break(lifecycle, AS_OF))
        .unionByName(op.detect_amount_break(lifecycle))
    )
    assert rows(one_pass) == rows(separate)
    assert one_pass.count() > 20
    for df in (one_pass, separate, op.all_breaks(lifecycle, claim(spark, "80.00", "90.00")[1], AS_OF)):
        assert dict(df.dtypes) == BREAK_FIELDS and df.columns == list(BREAK_FIELDS)


def test_age_is_negative_for_a_payment_after_the_as_of_date(spark):
    filed = claims(spark, ("K1", "C1", "V1", "2025-06-20", "80.00"))
    made = payments(spark, ("R1", "K1", "V1", "2025-07-04", "99.00"))
    held = contracts(spark, ("C1", "S1", "M1", "2025-01-01", "50.00", "500.00"))
    found = op.finish_breaks(op.detect_overpayment(op.claim_lifecycle(filed, made, held)), AS_OF)
    assert rows(found, "days_open", "as_of_date") == [(-3, AS_OF)]
