"""Staging, lifecycle joins, break detection and break numbering."""

from tripartite.operators.detect import (
    all_breaks,
    claim_breaks,
    contract_breaks,
    contract_payouts,
    detect_amount_break,
    detect_coverage_exceeded,
    detect_duplicate_claim,
    detect_orphan_claim,
    detect_orphan_contract,
    detect_overpayment,
    detect_timing_break,
    finish_breaks,
)
from tripartite.operators.lifecycle import (
    BY_CLAIM,
    claim_lifecycle,
    claims_with_contract,
    contract_lifecycle,
    contract_terms,
    paid_claims,
)
from tripartite.operators.numbering import with_break_key
from tripartite.operators.staging import (
    stage_all,
    stage_claims,
    stage_contracts,
    stage_merchant_sales,
    stage_servicer_reimbursements,
)

__all__ = [
    "BY_CLAIM",
    "all_breaks",
    "claim_breaks",
    "claim_lifecycle",
    "claims_with_contract",
    "contract_breaks",
    "contract_lifecycle",
    "contract_payouts",
    "contract_terms",
    "detect_amount_break",
    "detect_coverage_exceeded",
    "detect_duplicate_claim",
    "detect_orphan_claim",
    "detect_orphan_contract",
    "detect_overpayment",
    "detect_timing_break",
    "finish_breaks",
    "paid_claims",
    "stage_all",
    "stage_claims",
    "stage_contracts",
    "stage_merchant_sales",
    "stage_servicer_reimbursements",
    "with_break_key",
]
