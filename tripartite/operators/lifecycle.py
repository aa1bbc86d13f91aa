"""Lifecycle joins: what became of each contract and of each claim.

Skew. A foreign key may be hot (a third of the payments on one claim, a third of
the contracts on one sale). Adaptive execution splits a hot partition of an inner
join on either side, but of a left join only on the left. So many-to-one lookups
keep the many side on the left, and the one-to-many join of claims to payments is
written as an inner join plus the claims that have no payment.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripartite.functions import holds

TOLERANCE = Decimal("0.01")

# What claims and payments meet on where rows are grouped by claim behind it: equal claim ids,
# or none on either side.
BY_CLAIM = ("coalesce(claim_id, '')", "claim_id is null")


def contract_lifecycle(
    contracts: DataFrame, sales: DataFrame, tolerance: Decimal = TOLERANCE
) -> DataFrame:
    """Each contract with the sale behind it, if there is one.

    The flags are null, not false, where there is no sale to judge by.
    """
    issued = contracts.selectExpr(
        "contract_id",
        "sale_id as contract_sale_id",
        "merchant_id as contract_merchant_id",
        "issued_date",
        "premium as contract_premium",
        "coverage_limit",
        "term_months",
        "status as contract_status",
    )
    sold = sales.selectExpr(
        "sale_id as matched_sale_id",
        "merchant_id as sale_merchant_id",
        "sale_date",
        "product_price",
        "premium_charged as sale_premium_charged",
        "remittance_amount as sale_remittance_amount",
        "remittance_date as sale_remittance_date",
    )
    off = f"abs(coalesce(sale_remittance_amount, 0) - contract_premium) > {tolerance}"
    return issued.join(
        sold, F.col("contract_sale_id") == F.col("matched_sale_id"), "left"
    ).selectExpr(
        "*",
        "matched_sale_id is null as is_orphan_contract",
        "if(matched_sale_id is null, null, sale_remittance_date is null) as is_unpaid",
        f"if(matched_sale_id is null, null, {holds(off)}) as has_amount_break",
    )


def claims_with_contract(claims: DataFrame, contracts: DataFrame) -> DataFrame:
    """Each claim with the contract it was filed against, if that exists."""
    filed = claims.selectExpr(
        "claim_id",
        "contract_id as claim_contract_id",
        "servicer_id as claim_servicer_id",
        "claim_date",
        "claim_amount",
    )
    covered = contracts.selectExpr("contract_id as matched_contract_id", "coverage_limit")
    return filed.join(
        covered, F.col("claim_contract_id") == F.col("matched_contract_id"), "left"
    ).selectExpr("*", "matched_contract_id is null as is_orphan_claim")


def _payments(reimbursements: DataFrame) -> DataFrame:
    return reimbursements.where("claim_id is not null").selectExpr(
        "claim_id as paid_claim_id", "reimbursement_id", "paid_date", "paid_amount"
    )


def _overpaid(tolerance: Decimal) -> str:
    over = f"paid_amount > claim_amount + {tolerance}"
    return f"if(paid_amount is null, null, {holds(over)}) as is_overpayment"


def paid_claims(
    claims: DataFrame, reimbursements: DataFrame, tolerance: Decimal = TOLERANCE
) -> DataFrame:
    """One row per payment with its claim: the part of the claim lifecycle that the rules
    on payments need, without the contracts and the claims that were not paid."""
    filed = claims.selectExpr(
        "claim_id",
        "contract_id as claim_contract_id",
        "servicer_id as claim_servicer_id",
        "claim_date",
        "claim_amount",
    )
    same_claim = F.col("claim_id") == F.col("paid_claim_id")
    paid = filed.join(_payments(reimbursements), same_claim).drop("paid_claim_id")
    return paid.selectExpr("*", _overpaid(tolerance))


def contract_terms(contracts: DataFrame) -> DataFrame:
    """What a payout is held against, named as in the contract lifecycle."""
    return contracts.selectExpr(
        "contract_id", "merchant_id as contract_merchant_id", "issued_date", "coverage_limit"
    )


def claim_lifecycle(
    claims: DataFrame,
    reimbursements: DataFrame,
    contracts: DataFrame,
    tolerance: Decimal = TOLERANCE,
    grouped: bool = False,
) -> DataFrame:
    """One row per claim and payment; a claim without payment keeps one row. ``grouped`` says
    that rows will be grouped by claim (:data:`BY_CLAIM`), which then takes no shuffle."""
    return claims_with_payments(claims_with_contract(claims, contracts), reimbursements, tolerance, grouped)


def claims_with_payments(
    filed: DataFrame, reimbursements: DataFrame, tolerance: Decimal = TOLERANCE, grouped: bool = False
) -> DataFrame:
    """The claim lifecycle from :func:`claims_with_contract`, safe for hot claims."""
    payments = _payments(reimbursements)
    # One row per claim and map task goes into the shuffle, however hot the claim.
    paid_claims = payments.select("paid_claim_id").distinct()

    # Null-safe, so that the inner join puts no null filter on its copy of the claims:
    # both joins then read the same shuffle of them. Payments without a claim are gone
    # already, so a null claim id still meets nothing.
    same_claim = F.col("claim_id").eqNullSafe(F.col("paid_claim_id"))
    if grouped:  # the same in expressions that a grouping can name
        same_claim = F.expr(" and ".join(f"({e}) = ({e.replace('claim_id', 'paid_claim_id')})" for e in BY_CLAIM))
    # Under new names, as what a union puts out is not tidied below it: the claims of the
    # first join would differ from those of the second and travel twice.
    paid = filed.join(payments, same_claim).selectExpr(*[f"{c} as {c}" for c in filed.columns + payments.columns[1:]])
    unpaid = filed.join(paid_claims, same_claim, "left_anti")
    nothing = [f"cast(null as {kind}) as {c}" for c, kind in payments.dtypes[1:]]
    return _with_flags(paid.unionByName(unpaid.selectExpr("*", *nothing)), tolerance)


def claims_with_few_payments(
    filed: DataFrame, reimbursements: DataFrame, tolerance: Decimal = TOLERANCE
) -> DataFrame:
    """The same as one left join, which keeps to a layout by claim: for tables in which
    no claim has more payments than a task can take."""
    same_claim = F.col("claim_id") == F.col("paid_claim_id")
    return _with_flags(filed.join(_payments(reimbursements), same_claim, "left"), tolerance)


def _with_flags(claims: DataFrame, tolerance: Decimal) -> DataFrame:
    return claims.selectExpr(
        "claim_id",
        "claim_contract_id",
        "claim_servicer_id",
        "claim_date",
        "claim_amount",
        "reimbursement_id",
        "paid_date",
        "paid_amount",
        "matched_contract_id",
        "coverage_limit",
        "is_orphan_claim",
        "reimbursement_id is null as is_unpaid_claim",
        _overpaid(tolerance),
    )
