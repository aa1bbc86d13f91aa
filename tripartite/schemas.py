"""Schemas of the raw feeds and of the tables this library writes.

Raw feeds are read as text, column by column, so a bad value surfaces in the
staging cast instead of being nulled by the file reader.
"""

MONEY = "decimal(12,2)"
# Differences and sums of money. Twelve digits above a single amount leave room
# for the total of one very large claim or contract.
MONEY_TOTAL = "decimal(24,2)"
# Totals over the whole fact: sum() widens by ten digits.
MONEY_REPORT = "decimal(34,2)"


# Column types after staging, in column order.
STAGED_TYPES: dict[str, dict[str, str]] = {
    "merchants": dict.fromkeys(["merchant_id", "merchant_name", "category"], "string"),
    "servicers": dict.fromkeys(["servicer_id", "servicer_name"], "string"),
    "merchant_sales": {
        "sale_id": "string",
        "merchant_id": "string",
        "sale_date": "date",
        "product_price": MONEY,
        "premium_charged": MONEY,
        "remittance_amount": MONEY,
        "remittance_date": "date",
        "customer_email": "string",
    },
    "contracts": {
        "contract_id": "string",
        "sale_id": "string",
        "merchant_id": "string",
        "issued_date": "date",
        "premium": MONEY,
        "coverage_limit": MONEY,
        "term_months": "int",
        "status": "string",
    },
    "claims": {
        "claim_id": "string",
        "contract_id": "string",
        "servicer_id": "string",
        "claim_date": "date",
        "claim_amount": MONEY,
        "status": "string",
    },
    "servicer_reimbursements": {
        "reimbursement_id": "string",
        "claim_id": "string",
        "servicer_id": "string",
        "paid_date": "date",
        "paid_amount": MONEY,
    },
}


# Columns of a detected break, and of the fact, in order.
BREAK_FIELDS = {
    "break_type": "string",
    "severity": "string",
    "entity_id": "string",
    "entity_type": "string",
    "merchant_id": "string",
    "servicer_id": "string",
    "opened_at": "date",
    "amount_at_risk": MONEY_TOTAL,
    "description": "string",
}
# A break in short: the number of its type, the entity, its merchant or servicer, and what was
# measured, which the rest follows from.
MARK_FIELDS = {
    "rule": "tinyint",
    "id": "string",
    "party": "string",
    "opened": "date",
    "held": MONEY,
    "total": MONEY_TOTAL,
    "payments": "bigint",
}
FACT_FIELDS = {
    "break_key": "bigint",
    "break_type": "string",
    "severity": "string",
    "entity_type": "string",
    "entity_id": "string",
    "merchant_id": "string",
    "servicer_id": "string",
    "opened_at": "date",
    "days_open": "int",
    "amount_at_risk": MONEY_TOTAL,
    "description": "string",
    "as_of_date": "date",
}


def ddl(fields: dict[str, str]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in fields.items())


RAW_SCHEMAS = {feed: ddl(dict.fromkeys(columns, "string")) for feed, columns in STAGED_TYPES.items()}
TRUTH_SCHEMA = ddl(
    dict.fromkeys(
        ["break_type", "sale_id", "contract_id", "claim_id", "reimbursement_id", "detail"],
        "string",
    )
)
BREAK_SCHEMA = ddl(BREAK_FIELDS)
FACT_SCHEMA = ddl(FACT_FIELDS)
FACT_COLUMNS = list(FACT_FIELDS)

# The history keeps the fact's columns under a date of its own.
SNAPSHOT_COLUMNS = ["snapshot_date", *[c for c in FACT_COLUMNS if c != "as_of_date"]]
SNAPSHOT_SCHEMA = ddl({"snapshot_date": "date"} | {c: k for c, k in FACT_FIELDS.items() if c in SNAPSHOT_COLUMNS})
SNAPSHOT_KEY = ["snapshot_date", "break_key"]

# The closed vocabularies the fact is checked against.
BREAK_TYPES = [
    "orphan_contract",
    "timing_break",
    "amount_break",
    "orphan_claim",
    "duplicate_claim",
    "overpayment",
    "coverage_exceeded",
]
SEVERITIES = ["high", "medium", "low"]
ENTITY_TYPES = ["contract", "claim", "reimbursement"]
