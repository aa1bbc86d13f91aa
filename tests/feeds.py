"""A small set of raw feeds, as text, with known breaks, as a user would hold in CSV."""

HEADERS = {
    "merchants": "merchant_id,merchant_name,category",
    "servicers": "servicer_id,servicer_name",
    "merchant_sales": "sale_id,merchant_id,sale_date,product_price,premium_charged,"
    "remittance_amount,remittance_date,customer_email",
    "contracts": "contract_id,sale_id,merchant_id,issued_date,premium,coverage_limit,"
    "term_months,status",
    "claims": "claim_id,contract_id,servicer_id,claim_date,claim_amount,status",
    "servicer_reimbursements": "reimbursement_id,claim_id,servicer_id,paid_date,paid_amount",
}


def build() -> dict[str, list[str]]:
    feeds: dict[str, list[str]] = {name: [] for name in HEADERS}
    feeds["merchants"] = ["M1,Lamps & Co,home", "M2,Bikes,sport", "M3,Idle,none"]
    feeds["servicers"] = ["V1,Menders", "V2,Fixers"]
    for i in range(1, 31):
        merchant = f"M{1 + i % 2}"
        premium = 20 + i
        remitted, on = premium, "2025-03-05"
        if i in (1, 2):
            remitted, on = 0, ""  # unpaid: a timing and an amount break each
        if i == 3:
            remitted = premium - 5  # amount break
        feeds["contracts"].append(
            f"C{i},S{i},{merchant},2025-03-01,{premium}.0,1000.0,12,active"
        )
        if i != 4:  # C4 is an orphan
            feeds["merchant_sales"].append(
                f"S{i},{merchant},2025-03-01,1000.0,{premium}.0,{remitted}.0,{on},c{i}@example.com"
            )
    for i in range(1, 11):
        contract = "C404" if i == 10 else f"C{i}"  # K10 is an orphan
        amount = "600.0" if i == 5 else "100.0"
        feeds["claims"].append(f"K{i},{contract},V{1 + i % 2},2025-04-01,{amount},approved")
        if i != 9:  # K9 is not paid
            paid = "130.005" if i == 6 else amount  # R6 is an overpayment
            feeds["servicer_reimbursements"].append(f"R{i},K{i},V1,2025-04-20,{paid}")
    # K5 is paid twice, which also exceeds the limit of C5.
    feeds["servicer_reimbursements"].append("R50,K5,V1,2025-04-21,600.0")
    return feeds


EXPECTED = {
    "orphan_contract": 1,
    "timing_break": 2,
    "amount_break": 3,
    "orphan_claim": 1,
    "duplicate_claim": 1,
    "overpayment": 1,
    "coverage_exceeded": 1,
}


def write(folder, feeds=None) -> str:
    for name, lines in (feeds or build()).items():
        (folder / f"{name}.csv").write_text("\n".join([HEADERS[name], *lines]) + "\n")
    return str(folder)
