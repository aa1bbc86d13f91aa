"""The seven break detectors and the fact built from them.

Each break type is a :class:`BreakRule`: when a row is a break, and what is reported
of it. Five rules look at a single lifecycle row, so several of them can share one
read of the lifecycle (:func:`contract_breaks`). The rules for duplicate claims and
exceeded coverage look at a row per claim and per contract, formed by aggregation;
:func:`claim_breaks` forms both, and the other breaks of claims, from one read.

A break that has to travel is a mark (``MARK_FIELDS``): its rule, whom it is about and what
was measured. What follows from these, such as its wording, is told where it arrives.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripartite.functions import day, days_between, describe, money_total, text
from tripartite.schemas import BREAK_TYPES, MARK_FIELDS, MONEY, MONEY_TOTAL

SLA_DAYS = 14
HIGH_AFTER_DAYS = 30

# The wording of the break descriptions, with {} for the measured values.
DESCRIPTIONS = {
    "orphan_contract": "Contract issued but no matching merchant sale exists.",
    "timing_break": "Merchant has not remitted premium within {} days of contract issuance.",
    "amount_break": "Remittance amount {} does not match contract premium {}",
    "orphan_claim": "Claim references contract_id that does not exist in the contracts table.",
    "duplicate_claim": "Claim reimbursed {} times, total paid = {}",
    "overpayment": "Paid {} exceeds claim amount {}",
    "coverage_exceeded": "Total paid {} exceeds coverage_limit {}",
}


@dataclass(frozen=True)
class BreakRule:
    """One break type over rows of one shape; the fields are SQL expressions."""

    break_type: str
    condition: str
    entity_type: str
    opened_at: str
    amount: str
    severity: str = "'high'"
    merchant: str = "null"
    servicer: str = "null"
    measured: tuple[str, ...] = ()

    def fields(self) -> dict[str, str]:
        """What a break reports, by column, in the order and types of ``BREAK_SCHEMA``."""
        return {
            "break_type": text(self.break_type),
            "severity": self.severity,
            "entity_id": f"{self.entity_type}_id",
            "entity_type": text(self.entity_type),
            "merchant_id": f"cast({self.merchant} as string)",
            "servicer_id": f"cast({self.servicer} as string)",
            "opened_at": self.opened_at,
            "amount_at_risk": money_total(self.amount),
            "description": describe(DESCRIPTIONS[self.break_type], *self.measured),
        }

    def columns(self) -> list[str]:
        """The select list of a break."""
        return [f"{expression} as {name}" for name, expression in self.fields().items()]

    def detect(self, rows: DataFrame) -> DataFrame:
        return rows.where(self.condition).selectExpr(*self.columns())


def _one_pass(rows: DataFrame, rules: list[BreakRule]) -> DataFrame:
    """The breaks of several rules from one read of the rows they share."""
    found = [f"if({r.condition}, struct({', '.join(r.columns())}), null)" for r in rules]
    return rows.where(" or ".join(f"({r.condition})" for r in rules)).selectExpr(
        f"inline(array_compact(array({', '.join(found)})))"
    )


ORPHAN_CONTRACT = BreakRule(
    "orphan_contract",
    condition="is_orphan_contract",
    entity_type="contract",
    opened_at="issued_date",
    amount="contract_premium",
    merchant="contract_merchant_id",
)


def timing_severity(opened: str, as_of: date, high_after_days: int) -> str:
    return f"if({days_between(opened, day(as_of))} > {high_after_days}, 'high', 'medium')"


def timing_rule(as_of: date, sla_days: int, high_after_days: int) -> BreakRule:
    age = days_between("issued_date", day(as_of))
    return BreakRule(
        "timing_break",
        condition=f"not is_orphan_contract and is_unpaid and {age} > {sla_days}",
        severity=timing_severity("issued_date", as_of, high_after_days),
        entity_type="contract",
        opened_at="issued_date",
        amount="contract_premium",
        merchant="contract_merchant_id",
        measured=(str(sla_days),),
    )


AMOUNT_BREAK = BreakRule(
    "amount_break",
    condition="has_amount_break",
    severity="'medium'",
    entity_type="contract",
    opened_at="issued_date",
    amount="abs(coalesce(sale_remittance_amount, 0) - contract_premium)",
    merchant="contract_merchant_id",
    measured=("sale_remittance_amount", "contract_premium"),
)

ORPHAN_CLAIM = BreakRule(
    "orphan_claim",
    condition="is_orphan_claim",
    entity_type="claim",
    opened_at="claim_date",
    amount="claim_amount",
    servicer="claim_servicer_id",
)

DUPLICATE_CLAIM = BreakRule(
    "duplicate_claim",
    condition="payments > 1",
    entity_type="claim",
    opened_at="claim_date",
    amount="total_paid - claim_amount",
    servicer="claim_servicer_id",
    measured=("payments", "total_paid"),
)

OVERPAYMENT = BreakRule(
    "overpayment",
    condition="is_overpayment",
    severity="'medium'",
    entity_type="reimbursement",
    opened_at="paid_date",
    amount="paid_amount - claim_amount",
    servicer="claim_servicer_id",
    measured=("paid_amount", "claim_amount"),
)

COVERAGE_EXCEEDED = BreakRule(
    "coverage_exceeded",
    condition="total_paid > coverage_limit",
    entity_type="contract",
    opened_at="issued_date",
    amount="total_paid - coverage_limit",
    merchant="contract_merchant_id",
    measured=("total_paid", "coverage_limit"),
)


def detect_orphan_contract(contract_lifecycle: DataFrame) -> DataFrame:
    """Contracts without a sale."""
    return ORPHAN_CONTRACT.detect(contract_lifecycle)


def detect_timing_break(
    contract_lifecycle: DataFrame,
    as_of: date,
    sla_days: int = SLA_DAYS,
    high_after_days: int = HIGH_AFTER_DAYS,
) -> DataFrame:
    """Sales still unpaid more than ``sla_days`` after the contract was issued."""
    return timing_rule(as_of, sla_days, high_after_days).detect(contract_lifecycle)


def detect_amount_break(contract_lifecycle: DataFrame) -> DataFrame:
    """Remittances that differ from the premium; an unpaid one counts as 0."""
    return AMOUNT_BREAK.detect(contract_lifecycle)


def detect_orphan_claim(claims: DataFrame) -> DataFrame:
    """Claims on a contract that does not exist, once each.

    Takes the claim lifecycle, or :func:`claims_with_contract`, which answers the
    same without touching the payments.
    """
    return ORPHAN_CLAIM.detect(claims).distinct()


def detect_duplicate_claim(claim_lifecycle: DataFrame) -> DataFrame:
    """Claims reimbursed more than once; the amount is what exceeds one claim.

    Takes the claim lifecycle or :func:`paid_claims`, as the next three do.
    """
    per_claim = (
        claim_lifecycle.where("reimbursement_id is not null")
        .groupBy("claim_id")
        .agg(
            F.min("claim_servicer_id").alias("claim_servicer_id"),
            F.min("claim_date").alias("claim_date"),
            F.max("claim_amount").alias("claim_amount"),
            F.sum("paid_amount").alias("total_paid"),
            F.count("*").alias("payments"),
        )
    )
    return DUPLICATE_CLAIM.detect(per_claim)


def detect_overpayment(claim_lifecycle: DataFrame) -> DataFrame:
    """Payments above the amount claimed, reported against the claim's servicer."""
    return OVERPAYMENT.detect(claim_lifecycle)


def contract_payouts(claim_lifecycle: DataFrame) -> DataFrame:
    """Everything paid so far on each contract named by a claim."""
    total = f"cast(sum(coalesce(paid_amount, 0)) as {MONEY_TOTAL}) as total_paid"
    return (
        claim_lifecycle.where("claim_contract_id is not null and reimbursement_id is not null")
        .groupBy(F.col("claim_contract_id").alias("contract_id"))
        .agg(F.expr(total))
    )


def detect_coverage_exceeded(
    contract_lifecycle: DataFrame, claim_lifecycle: DataFrame
) -> DataFrame:
    """Contracts whose payouts add up to more than their coverage limit.

    Payouts are one row per contract before they meet the contracts. Instead of the
    contract lifecycle, :func:`contract_terms` will do.
    """
    terms = contract_lifecycle.select(
        "contract_id", "contract_merchant_id", "issued_date", "coverage_limit"
    )
    return COVERAGE_EXCEEDED.detect(contract_payouts(claim_lifecycle).join(terms, "contract_id"))


def contract_breaks(
    contract_lifecycle: DataFrame,
    as_of: date,
    sla_days: int = SLA_DAYS,
    high_after_days: int = HIGH_AFTER_DAYS,
) -> DataFrame:
    """Orphan contracts, timing and amount breaks from one read."""
    rules = [ORPHAN_CONTRACT, timing_rule(as_of, sla_days, high_after_days), AMOUNT_BREAK]
    return _one_pass(contract_lifecycle, rules)


# Whether rows lie by claim already, or the expressions of the claim by which they do.
Dealt = bool | tuple[str, ...]

# What a row of the claim lifecycle counts towards: columns that tell groups apart, the
# most selective first, and columns that are aggregated in each group.
_GROUP = {
    "id": "string", "rule": "tinyint", "servicer": "string", "opened": "date", "claimed": MONEY, "copy": "bigint"
}
_SUMMED = {"any_servicer": "string", "first_filed": "date", "most_claimed": MONEY, "paid": MONEY}


def _code(rule: str) -> str:
    """The number that stands for a break type while its rows travel."""
    return f"{BREAK_TYPES.index(rule)}Y"


def _part(rule: str, **values: str) -> str:
    """A struct of :data:`_GROUP` and :data:`_SUMMED`; what is not given is null."""
    given = values | {"rule": _code(rule)}
    fields = [f"cast({given.get(c, 'null')} as {kind}) as {c}" for c, kind in (_GROUP | _SUMMED).items()]
    return f"struct({', '.join(fields)})"


_PARTS = {
    "orphan_claim": (
        "is_orphan_claim",
        _part("orphan_claim", id="claim_id", servicer="claim_servicer_id", opened="claim_date", claimed="claim_amount"),
    ),
    # Each payment stands for itself, even if it is repeated.
    "overpayment": (
        "is_overpayment",
        _part("overpayment", id="reimbursement_id", servicer="claim_servicer_id", opened="paid_date",
              claimed="claim_amount", copy="copy", paid="paid_amount"),
    ),
    "duplicate_claim": (
        "reimbursement_id is not null",
        _part("duplicate_claim", id="claim_id", any_servicer="claim_servicer_id", first_filed="claim_date",
              most_claimed="claim_amount", paid="paid_amount"),
    ),
    "coverage_exceeded": (
        "reimbursement_id is not null and claim_contract_id is not null",
        _part("coverage_exceeded", id="claim_contract_id", paid="coalesce(paid_amount, 0)"),
    ),
}


# A group of :func:`_claim_groups`, each value in one place.
_FOUND = [
    "rule",
    "id",
    "coalesce(servicer, any_servicer) as servicer",
    "coalesce(opened, first_filed) as opened",
    "coalesce(claimed, most_claimed) as claimed",
    "total_paid",
]


def _lies_by(dealt: Dealt) -> tuple[str, ...]:
    return ("claim_id",) if dealt is True else tuple(dealt or ())


def _claim_groups(claims: DataFrame, dealt: Dealt) -> DataFrame:
    """The groups that the rows of :func:`claim_breaks` count for, summed up."""
    parts = [part for rule, part in _PARTS.items() if rule != "orphan_claim" or part[0] in claims.columns]
    counted = ", ".join(f"if({condition}, {part}, null)" for condition, part in parts)
    where = {e: f"lies_by_{i}" for i, e in enumerate(_lies_by(dealt))}
    return (
        claims.selectExpr("*", "monotonically_increasing_id() as copy")
        .selectExpr(*[f"{c} as {name}" for c, name in where.items()], f"inline(array_compact(array({counted})))")
        .groupBy(*where.values(), *_GROUP)
        .agg(
            F.min("any_servicer").alias("any_servicer"),
            F.min("first_filed").alias("first_filed"),
            F.max("most_claimed").alias("most_claimed"),
            F.sum("paid").cast(MONEY_TOTAL).alias("total_paid"),
            F.count(F.lit(1)).alias("payments"),
        )
        .where(f"rule <> {_code('duplicate_claim')} or payments > 1")
    )


def claim_breaks(claims: DataFrame, terms: DataFrame, dealt: Dealt = False) -> DataFrame:
    """Orphan claims, duplicates, overpayments and exceeded coverage from one read of the
    claim lifecycle, or of :func:`paid_claims`, which has no orphans.

    A row goes into the groups of the rules it counts for: its claim, its contract, itself
    if it is an overpayment. All groups form in one shuffle, summed up before it, so a hot
    claim or contract sends one row per task. The contracts' totals then meet ``terms``, the
    contract lifecycle or :func:`contract_terms`; finished breaks pass that join without a
    partner, under keys that spread them over its tasks.

    ``dealt`` says that the rows lie by claim already, as a join on the claim leaves them, or
    by expressions of it (``BY_CLAIM`` for a claim lifecycle made to be ``grouped``).
    Groups are then formed where the rows are, a claim at a time, without that shuffle; what
    was paid on a contract is added up behind the join with the terms, which adaptive
    execution splits if the contract is hot.
    """
    # Nothing twice: these rows travel once more.
    found = _claim_groups(claims, dealt).selectExpr(
        *_FOUND,
        # Payments of a duplicate; of an overpayment, which copy of it.
        f"if(rule = {_code('duplicate_claim')}, payments, copy) as mark",
    )
    held = terms.select("contract_id", "contract_merchant_id", "issued_date", "coverage_limit")
    # Each row of the terms by itself, also where contracts are repeated.
    held = held.withColumn("term", F.monotonically_increasing_id()) if dealt else held
    covered = f"rule = {_code('coverage_exceeded')}"
    against = F.expr(f"if({covered}, id, concat('\u0000', id))")
    joined = found.join(held, (against == F.col("contract_id")) & F.expr(covered), "left")
    if dealt:
        whole = [c for c in joined.columns if c != "total_paid"]
        totals = F.sum("total_paid").cast(MONEY_TOTAL).alias("total_paid")
        joined = joined.withColumn("held_against", against).groupBy("held_against", *whole).agg(totals)
    # Under the names that the rules use.
    met_terms = joined.selectExpr(
        "rule",
        "id as claim_id",
        "id as reimbursement_id",
        "servicer as claim_servicer_id",
        "opened as claim_date",
        "opened as paid_date",
        "claimed as claim_amount",
        "total_paid",
        "mark as payments",
        "contract_id",
        "contract_merchant_id",
        "issued_date",
        "coverage_limit",
    )
    one_payment = replace(
        OVERPAYMENT, condition="true", amount="total_paid - claim_amount", measured=("total_paid", "claim_amount")
    )
    rules = [
        replace(rule, condition=f"rule = {_code(rule.break_type)} and {rule.condition}")
        for rule in (replace(ORPHAN_CLAIM, condition="true"), one_payment, DUPLICATE_CLAIM, COVERAGE_EXCEEDED)
    ]
    return _one_pass(met_terms, rules)


def all_breaks(
    contract_lifecycle: DataFrame,
    claim_lifecycle: DataFrame,
    as_of: date,
    sla_days: int = SLA_DAYS,
    high_after_days: int = HIGH_AFTER_DAYS,
    terms: DataFrame | None = None,
    dealt: Dealt = False,
) -> DataFrame:
    """Every break, unnumbered. The claim lifecycle is read once, the contract lifecycle
    once for its own rules and once for the terms of the contracts, unless ``terms``
    (:func:`contract_terms`) are given. Neither needs to be written before. ``dealt`` as in
    :func:`claim_breaks`."""
    return contract_breaks(contract_lifecycle, as_of, sla_days, high_after_days).unionByName(
        claim_breaks(claim_lifecycle, contract_lifecycle if terms is None else terms, dealt)
    )


def _finished(as_of: date) -> list[str]:
    return [
        "break_type",
        "severity",
        "entity_type",
        "entity_id",
        "merchant_id",
        "servicer_id",
        "opened_at",
        f"{days_between('opened_at', day(as_of))} as days_open",
        f"{money_total('round(amount_at_risk, 2)')} as amount_at_risk",
        "description",
        f"{day(as_of)} as as_of_date",
    ]


def finish_breaks(breaks: DataFrame, as_of: date) -> DataFrame:
    """Adds age and as-of date: the fact without its key."""
    return breaks.selectExpr(*_finished(as_of))


# ---- marks -------------------------------------------------------------------


def _mark(rule: str, **values: str) -> list[str]:
    """The select list of a mark; what is not given is null."""
    given = values | {"rule": _code(rule)}
    return [f"cast({given.get(c, 'null')} as {kind}) as {c}" for c, kind in MARK_FIELDS.items()]


def contract_marks(contract_lifecycle: DataFrame, as_of: date, sla_days: int = SLA_DAYS) -> DataFrame:
    """:func:`contract_breaks` as marks."""
    about = {"id": "contract_id", "party": "contract_merchant_id", "opened": "issued_date", "held": "contract_premium"}
    marks = [
        (ORPHAN_CONTRACT, _mark("orphan_contract", **about)),
        (timing_rule(as_of, sla_days, HIGH_AFTER_DAYS), _mark("timing_break", **about)),
        (AMOUNT_BREAK, _mark("amount_break", **about, total="sale_remittance_amount")),
    ]
    found = [f"if({rule.condition}, struct({', '.join(mark)}), null)" for rule, mark in marks]
    return contract_lifecycle.where(" or ".join(f"({rule.condition})" for rule, _ in marks)).selectExpr(
        f"inline(array_compact(array({', '.join(found)})))"
    )


def claim_marks(filed: DataFrame, paid: DataFrame) -> DataFrame:
    """Orphan claims from :func:`claims_with_contract`; overpayments and duplicates from
    :func:`paid_claims`, and the payouts of each claim on its contract, which are no breaks yet
    (:func:`coverage_marks`). All as marks, in one plan, as both read the claims. What was
    paid lies by claim, so nothing travels for it."""
    return _payment_marks(paid).unionByName(_orphan_claim_marks(filed))


def lifecycle_marks(claims: DataFrame) -> DataFrame:
    """:func:`claim_marks` from one read of a claim lifecycle whose rows lie by claim."""
    return _payment_marks(claims)


def _payment_marks(paid: DataFrame) -> DataFrame:
    about = {"id": "id", "party": "servicer", "opened": "opened", "held": "claimed", "total": "total_paid"}
    payments = f"if(rule = {_code('duplicate_claim')}, payments, null)"
    given = about | {"rule": "rule", "payments": payments}
    return (
        _claim_groups(paid, dealt=True)
        .selectExpr(*_FOUND, "payments")
        .selectExpr(*[f"cast({given[c]} as {kind}) as {c}" for c, kind in MARK_FIELDS.items()])
    )


def _orphan_claim_marks(claims: DataFrame) -> DataFrame:
    """:func:`detect_orphan_claim` as marks."""
    about = {"id": "claim_id", "party": "claim_servicer_id", "opened": "claim_date", "held": "claim_amount"}
    return claims.where(ORPHAN_CLAIM.condition).selectExpr(*_mark("orphan_claim", **about)).distinct()


def coverage_marks(marks: DataFrame, terms: DataFrame) -> DataFrame:
    """Exceeded coverage as marks, from what :func:`claim_marks` say was paid."""
    payouts = (
        marks.where(f"rule = {_code('coverage_exceeded')}")
        .groupBy(F.col("id").alias("contract_id"))
        .agg(F.sum("total").cast(MONEY_TOTAL).alias("total_paid"))
    )
    held = terms.select("contract_id", "contract_merchant_id", "issued_date", "coverage_limit")
    about = {"id": "contract_id", "party": "contract_merchant_id", "opened": "issued_date", "held": "coverage_limit"}
    over = payouts.join(held, "contract_id").where(COVERAGE_EXCEEDED.condition)
    return over.selectExpr(*_mark("coverage_exceeded", **about, total="total_paid"))


def without_payouts(marks: DataFrame) -> DataFrame:
    """Those of :func:`claim_marks` that are breaks as they are."""
    return marks.where(f"rule <> {_code('coverage_exceeded')}")


def told(as_of: date, sla_days: int = SLA_DAYS, high_after_days: int = HIGH_AFTER_DAYS) -> dict[str, str]:
    """What a mark tells, by column of ``BREAK_SCHEMA``, as SQL over the columns of marks."""
    over = {"amount": "total - held", "measured": ("total", "held")}
    rules = [
        replace(ORPHAN_CONTRACT, amount="held", merchant="party"),
        replace(
            timing_rule(as_of, sla_days, high_after_days),
            severity=timing_severity("opened", as_of, high_after_days), amount="held", merchant="party",
        ),
        replace(AMOUNT_BREAK, amount="abs(coalesce(total, 0) - held)", measured=("total", "held"), merchant="party"),
        replace(ORPHAN_CLAIM, amount="held", servicer="party"),
        replace(DUPLICATE_CLAIM, amount="total - held", measured=("payments", "total"), servicer="party"),
        replace(OVERPAYMENT, **over, servicer="party"),
        replace(COVERAGE_EXCEEDED, **over, merchant="party"),
    ]
    fields = {rule.break_type: rule.fields() | {"entity_id": "id", "opened_at": "opened"} for rule in rules}

    def of(column: str) -> str:
        cases = {t: given[column] for t, given in fields.items()}
        if len(set(cases.values())) == 1:
            return next(iter(cases.values()))
        return f"case rule {' '.join(f'when {_code(t)} then {e}' for t, e in cases.items())} end"

    return {column: of(column) for column in rules[0].fields()}


def tell(
    marks: DataFrame, as_of: date, *kept: str, sla_days: int = SLA_DAYS, high_after_days: int = HIGH_AFTER_DAYS
) -> DataFrame:
    """Finished breaks as of a day from their marks, and behind them the columns ``kept``."""
    columns = [f"{e} as {c}" for c, e in told(as_of, sla_days, high_after_days).items()]
    return marks.selectExpr(*columns, *kept).selectExpr(*_finished(as_of), *kept)


def not_yet_late(as_of: date, sla_days: int = SLA_DAYS) -> tuple[str, date]:
    """The condition on marks of a later day that are no breaks on ``as_of``, and the day from
    which on these were opened."""
    first = as_of - timedelta(days=sla_days)
    return f"rule = {_code('timing_break')} and opened >= {day(first)}", first
