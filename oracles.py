"""DuckDB SQL that answers the same questions as ``__spark_entry__.queries``.

Written against the raw tables and independently of the Spark plans: plain outer
joins where Spark joins in parts, and one global ``row_number`` where it numbers in
parts. Repeated keys multiply rows here and there alike.
"""

from __future__ import annotations

from tripartite.functions.expressions import AGING_BUCKETS, OLDEST_BUCKET

# ---- the six feeds, typed ---------------------------------------------------------

_FEEDS = """
ordered AS (
  SELECT o_orderkey AS k, o_custkey, CAST(o_orderdate AS DATE) AS day,
         CAST(o_totalprice AS DECIMAL(12,2)) AS tp,
         'M' || lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS merchant_id,
         CAST(round(CAST(o_totalprice AS DECIMAL(12,2)) * CAST(0.10 AS DECIMAL(3,2)), 2) AS DECIMAL(12,2)) AS p10,
         CAST(round(CAST(o_totalprice AS DECIMAL(12,2)) * CAST(0.09 AS DECIMAL(3,2)), 2) AS DECIMAL(12,2)) AS p09
  FROM orders JOIN customer ON c_custkey = o_custkey),
lines AS (
  SELECT *, CAST(l_shipdate AS DATE) AS shipped,
         CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS cid
  FROM lineitem),
merchants AS (
  SELECT 'M' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS merchant_id, n_name AS merchant_name,
         'region-' || CAST(n_regionkey AS VARCHAR) AS category
  FROM nation),
servicers AS (
  SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS servicer_id, s_name AS servicer_name FROM supplier),
contracts AS (
  SELECT CAST(k AS VARCHAR) AS contract_id, 'T' || CAST(k AS VARCHAR) AS sale_id, merchant_id, day AS issued_date,
         p10 AS premium, tp AS coverage_limit, CAST(12 * (1 + k % 3) AS INTEGER) AS term_months,
         'active' AS status
  FROM ordered),
sales AS (
  SELECT 'T' || CAST(k AS VARCHAR) AS sale_id, merchant_id, day AS sale_date, tp AS product_price,
         p10 AS premium_charged,
         CASE WHEN k % 106 = 0 THEN NULL WHEN k % 53 = 0 THEN CAST(0 AS DECIMAL(12,2)) WHEN k % 37 = 0 THEN p09 ELSE p10 END
           AS remittance_amount,
         CASE WHEN k % 53 <> 0 THEN CAST(day + 5 AS VARCHAR) END AS remittance_date_raw,
         CASE WHEN k % 53 <> 0 THEN CAST(day + 5 AS DATE) END AS remittance_date,
         'cust_' || CAST(o_custkey AS VARCHAR) || '@example.com' AS customer_email
  FROM ordered WHERE k % 61 <> 0),
claims AS (
  SELECT cid AS claim_id,
         CASE WHEN l_orderkey % 71 = 0 THEN 'X' ELSE '' END || CAST(l_orderkey AS VARCHAR) AS contract_id,
         'S' || CAST(min(l_suppkey) AS VARCHAR) AS servicer_id, min(shipped) AS claim_date,
         CAST(min(l_extendedprice) AS DECIMAL(12,2)) AS claim_amount,
         CASE min(l_returnflag) WHEN 'A' THEN 'approved' WHEN 'N' THEN 'pending' WHEN 'R' THEN 'reopened' END AS status
  FROM lines GROUP BY cid, l_orderkey, l_linenumber),
payments AS (
  SELECT cid || '-' || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) || '-'
           || CAST(shipped AS VARCHAR) AS reimbursement_id,
         cid AS claim_id, 'S' || CAST(l_suppkey AS VARCHAR) AS servicer_id,
         CAST(shipped + 14 AS DATE) AS paid_date, CAST(l_extendedprice AS DECIMAL(12,2)) AS paid_amount
  FROM lines WHERE l_orderkey % 43 <> 0),
planted AS (
  SELECT 'orphan_contract' AS break_type, CAST(NULL AS VARCHAR) AS sale_id, CAST(k AS VARCHAR) AS contract_id,
         CAST(NULL AS VARCHAR) AS claim_id FROM ordered WHERE k % 61 = 0
  UNION ALL
  SELECT 'timing_break', 'T' || CAST(k AS VARCHAR), NULL, NULL FROM ordered WHERE k % 53 = 0 AND k % 61 <> 0
  UNION ALL
  SELECT 'amount_break', 'T' || CAST(k AS VARCHAR), NULL, NULL FROM ordered
  WHERE k % 37 = 0 AND k % 53 <> 0 AND k % 61 <> 0
  UNION ALL
  SELECT 'orphan_claim', NULL, NULL, cid FROM (SELECT DISTINCT cid FROM lines WHERE l_orderkey % 71 = 0))
"""

# ---- lifecycles --------------------------------------------------------------------

_CONTRACT_LIFECYCLE = """
SELECT k.contract_id, k.sale_id AS contract_sale_id, k.merchant_id AS contract_merchant_id, k.issued_date,
       k.premium AS contract_premium, k.coverage_limit, k.term_months, k.status AS contract_status,
       b.sale_id AS matched_sale_id, b.merchant_id AS sale_merchant_id, b.sale_date, b.product_price,
       b.premium_charged AS sale_premium_charged, b.remittance_amount AS sale_remittance_amount,
       b.remittance_date AS sale_remittance_date,
       b.sale_id IS NULL AS is_orphan_contract,
       CASE WHEN b.sale_id IS NOT NULL THEN b.remittance_date IS NULL END AS is_unpaid,
       CASE WHEN b.sale_id IS NOT NULL
            THEN coalesce(abs(coalesce(b.remittance_amount, 0) - k.premium) > 0.01, false) END AS has_amount_break
FROM contracts k LEFT JOIN sales b USING (sale_id)
"""

_CLAIM_LIFECYCLE = """
SELECT f.claim_id, f.contract_id AS claim_contract_id, f.servicer_id AS claim_servicer_id, f.claim_date,
       f.claim_amount, p.reimbursement_id, p.paid_date, p.paid_amount, k.contract_id AS matched_contract_id,
       k.coverage_limit, k.contract_id IS NULL AS is_orphan_claim,
       p.reimbursement_id IS NULL AS is_unpaid_claim,
       CASE WHEN p.paid_amount IS NOT NULL
            THEN coalesce(p.paid_amount > f.claim_amount + 0.01, false) END AS is_overpayment
FROM claims f LEFT JOIN payments p ON p.claim_id = f.claim_id
              LEFT JOIN contracts k ON k.contract_id = f.contract_id
"""

_MODELS = f"{_FEEDS}, lc AS ({_CONTRACT_LIFECYCLE}), lk AS ({_CLAIM_LIFECYCLE})"

# ---- detectors ----------------------------------------------------------------------


def _detector(break_type, severity, entity, entity_id, merchant, servicer, opened, amount, text, rest):
    return f"""
SELECT '{break_type}' AS break_type, {severity} AS severity, {entity_id} AS entity_id,
       '{entity}' AS entity_type, CAST({merchant} AS VARCHAR) AS merchant_id,
       CAST({servicer} AS VARCHAR) AS servicer_id, {opened} AS opened_at,
       CAST({amount} AS DECIMAL(24,2)) AS amount_at_risk, {text} AS description
{rest}"""


_AGE = "date_diff('day', issued_date, DATE '{as_of}')"
_HIGH, _MEDIUM = "'high'", "'medium'"
_ON_CONTRACT = ("contract", "contract_id", "contract_merchant_id", "NULL", "issued_date")
_ON_CLAIM = ("claim", "claim_id", "NULL", "claim_servicer_id", "claim_date")

# The wording of the descriptions.
_NO_SALE = "Contract issued but no matching merchant sale exists."
_NO_CONTRACT = "Claim references contract_id that does not exist in the contracts table."

_OF_SALE = ("contract", "contract_id", "merchant_id", "NULL", "issued_date")
_ORPHAN_CONTRACT = _detector(
    "orphan_contract", _HIGH, *_OF_SALE, "premium", f"'{_NO_SALE}'",
    "FROM contracts k WHERE NOT EXISTS (SELECT 1 FROM sales WHERE sales.sale_id = k.sale_id)",
)
_TIMING_BREAK = _detector(
    "timing_break", f"CASE WHEN {_AGE} > 30 THEN 'high' ELSE 'medium' END", *_OF_SALE, "premium",
    "'Merchant has not remitted premium within 14 days of contract issuance.'",
    f"FROM contracts k WHERE {_AGE} > 14"
    " AND k.sale_id IN (SELECT sale_id FROM sales WHERE remittance_date IS NULL)",
)
_AMOUNT_BREAK = _detector(
    "amount_break", _MEDIUM, *_ON_CONTRACT, "abs(coalesce(sale_remittance_amount, 0) - contract_premium)",
    "'Remittance amount ' || CAST(sale_remittance_amount AS VARCHAR) || ' does not match contract premium '"
    " || CAST(contract_premium AS VARCHAR)",
    "FROM lc WHERE matched_sale_id IS NOT NULL"
    " AND abs(coalesce(sale_remittance_amount, 0) - contract_premium) > 0.01",
)
_ORPHAN_CLAIM = "SELECT DISTINCT * FROM (" + _detector(
    "orphan_claim", _HIGH, "claim", "claim_id", "NULL", "servicer_id", "claim_date", "claim_amount",
    f"'{_NO_CONTRACT}'",
    "FROM claims f WHERE NOT EXISTS (SELECT 1 FROM contracts k WHERE k.contract_id = f.contract_id)",
) + ")"
_DUPLICATE_CLAIM = _detector(
    "duplicate_claim", _HIGH, *_ON_CLAIM, "total - claim_amount",
    "'Claim reimbursed ' || CAST(n AS VARCHAR) || ' times, total paid = ' || CAST(total AS VARCHAR)",
    "FROM (SELECT claim_id, min(claim_servicer_id) AS claim_servicer_id, min(claim_date) AS claim_date,"
    " max(claim_amount) AS claim_amount, count(*) AS n, sum(paid_amount) AS total"
    " FROM lk WHERE NOT is_unpaid_claim GROUP BY claim_id) WHERE n > 1",
)
_OVERPAYMENT = _detector(
    "overpayment", _MEDIUM, "reimbursement", "reimbursement_id", "NULL", "claim_servicer_id", "paid_date",
    "paid_amount - claim_amount",
    "'Paid ' || CAST(paid_amount AS VARCHAR) || ' exceeds claim amount ' || CAST(claim_amount AS VARCHAR)",
    "FROM lk WHERE paid_amount > claim_amount + 0.01",
)
_PAYOUTS = """
SELECT claim_contract_id AS contract_id, CAST(sum(coalesce(paid_amount, 0)) AS DECIMAL(24,2)) AS total_paid
FROM lk WHERE claim_contract_id IS NOT NULL AND NOT is_unpaid_claim GROUP BY claim_contract_id"""
_COVERAGE_EXCEEDED = _detector(
    "coverage_exceeded", _HIGH, *_ON_CONTRACT, "total_paid - coverage_limit",
    "'Total paid ' || CAST(total_paid AS VARCHAR) || ' exceeds coverage_limit '"
    " || CAST(coverage_limit AS VARCHAR)",
    f"FROM lc JOIN ({_PAYOUTS}) USING (contract_id) WHERE total_paid > coverage_limit",
)
_DETECTORS = {
    "detect_orphan_contract": _ORPHAN_CONTRACT,
    "detect_timing_break": _TIMING_BREAK,
    "detect_amount_break": _AMOUNT_BREAK,
    "detect_orphan_claim": _ORPHAN_CLAIM,
    "detect_duplicate_claim": _DUPLICATE_CLAIM,
    "detect_overpayment": _OVERPAYMENT,
    "detect_coverage_exceeded": _COVERAGE_EXCEEDED,
}

# ---- fact ------------------------------------------------------------------------------

AS_OF = "2001-08-01"
DAY_BEFORE = "2001-07-31"


def _fact(as_of: str) -> str:
    """The numbered fact at a date."""
    found = "\nUNION ALL\n".join(_DETECTORS.values()).replace("{as_of}", as_of)
    return f"""
SELECT row_number() OVER (ORDER BY opened_at NULLS LAST, entity_id NULLS LAST, break_type,
                          amount_at_risk, description NULLS LAST) AS break_key,
       break_type, severity, entity_type, entity_id, merchant_id, servicer_id, opened_at,
       CAST(date_diff('day', opened_at, DATE '{as_of}') AS INTEGER) AS days_open,
       amount_at_risk, description, DATE '{as_of}' AS as_of_date
FROM ({found})"""


_FACT = f"{_MODELS}, fact AS ({_fact(AS_OF)})"


def _day(snapshot_date: str, fact: str = "fact", extra: str = "") -> str:
    return f"""
SELECT DATE '{snapshot_date}' AS snapshot_date, break_key, break_type, severity, entity_type, entity_id,
       merchant_id, servicer_id, opened_at, days_open, amount_at_risk, description{extra}
FROM {fact}"""


_BUCKET = "CASE " + " ".join(f"WHEN days_open <= {last} THEN '{label}'" for last, label in AGING_BUCKETS)

_AGING = f"""
SELECT break_type, severity, aging_bucket, count(*) AS break_count,
       CAST(sum(amount_at_risk) AS DECIMAL(34,2)) AS total_amount_at_risk,
       round(avg(days_open), 1) AS avg_days_open, max(days_open) AS max_days_open
FROM (SELECT *, {_BUCKET} ELSE '{OLDEST_BUCKET}' END AS aging_bucket FROM fact)
GROUP BY break_type, severity, aging_bucket"""

_MERCHANT_TOTALS = """
SELECT merchant_id, count(DISTINCT contract_id) AS total_contracts,
       CAST(sum(premium) AS DECIMAL(34,2)) AS total_premium_expected
FROM contracts GROUP BY merchant_id"""

_MERCHANT_BREAKS = """
SELECT merchant_id, count(*) AS total_breaks, CAST(sum(amount_at_risk) AS DECIMAL(34,2)) AS total_amount_at_risk,
       count(*) FILTER (break_type = 'timing_break') AS timing_breaks,
       count(*) FILTER (break_type = 'amount_break') AS amount_breaks,
       count(*) FILTER (break_type = 'orphan_contract') AS orphan_contracts
FROM fact WHERE merchant_id IS NOT NULL GROUP BY merchant_id"""

_SCORECARD = f"""
SELECT m.merchant_id, merchant_name, category, coalesce(total_contracts, 0) AS total_contracts,
       CAST(coalesce(total_premium_expected, 0) AS DECIMAL(34,2)) AS total_premium_expected,
       coalesce(total_breaks, 0) AS total_breaks,
       CAST(coalesce(total_amount_at_risk, 0) AS DECIMAL(34,2)) AS total_amount_at_risk,
       coalesce(timing_breaks, 0) AS timing_breaks, coalesce(amount_breaks, 0) AS amount_breaks,
       coalesce(orphan_contracts, 0) AS orphan_contracts,
       CASE WHEN coalesce(total_contracts, 0) = 0 THEN 0.0
            ELSE round(CAST(coalesce(total_breaks, 0) AS DOUBLE) / total_contracts, 3) END AS break_rate
FROM merchants m LEFT JOIN ({_MERCHANT_TOTALS}) t ON t.merchant_id = m.merchant_id
                 LEFT JOIN ({_MERCHANT_BREAKS}) b ON b.merchant_id = m.merchant_id"""

_TRUTH = """
SELECT break_type, coalesce(planted, 0) AS planted, coalesce(detected, 0) AS detected,
       CASE WHEN coalesce(planted, 0) = 0 THEN 'N/A'
            ELSE CAST(CAST(round_even(CAST(coalesce(detected, 0) AS DOUBLE) / planted * 100, 0) AS BIGINT) AS VARCHAR)
                 || '%' END AS catch_rate
FROM (SELECT break_type, count(*) AS planted FROM planted GROUP BY break_type) x
FULL JOIN (SELECT break_type, count(*) AS detected FROM fact GROUP BY break_type) y USING (break_type)"""

_OVER_COVERAGE = """
SELECT p.reimbursement_id, p.paid_amount, k.contract_id, k.coverage_limit
FROM payments p, claims f, contracts k
WHERE f.claim_id = p.claim_id AND k.contract_id = f.contract_id AND p.paid_amount > k.coverage_limit"""

# ---- declared checks ---------------------------------------------------------------------


# Written out here, so that a check that goes missing in the library is missed.
_VIEWS = {
    "merchant_sales": "sales",
    "servicer_reimbursements": "payments",
    "stg_merchant_sales": "sales",
    "stg_contracts": "contracts",
    "stg_claims": "claims",
    "stg_servicer_reimbursements": "payments",
    "fct_recon_breaks": "fact",
    "fct_daily_break_snapshot": f"({_day(AS_OF)})",
}
_FILLED = {
    "merchants": "merchant_id",
    "servicers": "servicer_id",
    "merchant_sales": "sale_id merchant_id",
    "contracts": "contract_id",
    "claims": "claim_id",
    "servicer_reimbursements": "reimbursement_id",
    "stg_merchant_sales": "sale_id merchant_id product_price premium_charged",
    "stg_contracts": "contract_id sale_id premium coverage_limit",
    "stg_claims": "claim_id contract_id claim_amount",
    "stg_servicer_reimbursements": "reimbursement_id claim_id paid_amount",
    "fct_recon_breaks": "break_key break_type severity entity_type entity_id amount_at_risk days_open",
    "fct_daily_break_snapshot": "snapshot_date break_key break_type",
}
_KEYS = {
    "merchants": "merchant_id",
    "servicers": "servicer_id",
    "merchant_sales": "sale_id",
    "contracts": "contract_id",
    "claims": "claim_id",
    "servicer_reimbursements": "reimbursement_id",
    "stg_merchant_sales": "sale_id",
    "stg_contracts": "contract_id",
    "stg_claims": "claim_id",
    "stg_servicer_reimbursements": "reimbursement_id",
    "fct_recon_breaks": "break_key",
}
_TYPES = (
    "orphan_contract timing_break amount_break orphan_claim duplicate_claim overpayment coverage_exceeded"
)
_LISTED = [
    ("fct_recon_breaks", "break_type", _TYPES),
    ("fct_recon_breaks", "severity", "high medium low"),
    ("fct_recon_breaks", "entity_type", "contract claim reimbursement"),
    ("fct_daily_break_snapshot", "break_type", _TYPES),
]


def _checks() -> str:
    """All 48 declared checks as (check, status, failures)."""
    counts = [
        f"SELECT 'not_null_{table}_{c}' AS name, count(*) - count({c}) AS failures FROM {_VIEWS.get(table, table)}"
        for table, columns in _FILLED.items()
        for c in columns.split()
    ]
    counts += [
        f"SELECT 'unique_{table}_{c}', count(*) FROM (SELECT {c} FROM {_VIEWS.get(table, table)}"
        f" WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)"
        for table, c in _KEYS.items()
    ]
    counts += [
        f"SELECT 'accepted_values_{table}_{c}', count(DISTINCT {c}) FROM {_VIEWS.get(table, table)}"
        f" WHERE {c} NOT IN ({', '.join(repr(v) for v in values.split())})"
        for table, c, values in _LISTED
    ]
    counts.append(
        "SELECT 'relationships_merchant_sales_merchant_id_merchants', count(*) FROM sales b"
        " WHERE merchant_id IS NOT NULL"
        " AND NOT EXISTS (SELECT 1 FROM merchants m WHERE m.merchant_id = b.merchant_id)"
    )
    counts.append(
        f"SELECT 'reimbursement_never_exceeds_coverage', count(*) FROM ({_OVER_COVERAGE})"
    )
    return (
        "SELECT name AS \"check\", CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status, failures"
        f" FROM ({' UNION ALL '.join(counts)})"
    )


# ---- registry -----------------------------------------------------------------------------


def _filled(table: str, view: str, columns: list[str]) -> str:
    cells = " + ".join(f"count({c})" for c in columns)
    return f"SELECT '{table}' AS source_table, count(*) AS row_count, {cells} AS filled_fields FROM {view}"


_SRC_SCAN = " UNION ALL ".join([
    _filled("merchants", "merchants", ["merchant_id", "merchant_name", "category"]),
    _filled("servicers", "servicers", ["servicer_id", "servicer_name"]),
    _filled("merchant_sales", "sales", [
        "sale_id", "merchant_id", "sale_date", "product_price", "premium_charged", "remittance_amount",
        "remittance_date_raw", "customer_email"]),
    _filled("contracts", "contracts", [
        "contract_id", "sale_id", "merchant_id", "issued_date", "premium", "coverage_limit",
        "term_months", "status"]),
    _filled("claims", "claims", [
        "claim_id", "contract_id", "servicer_id", "claim_date", "claim_amount", "status"]),
    _filled("servicer_reimbursements", "payments", [
        "reimbursement_id", "claim_id", "servicer_id", "paid_date", "paid_amount"]),
])

_DRILLDOWN = """
SELECT break_type, severity, entity_type, entity_id, coalesce(merchant_id, servicer_id) AS counterparty,
       opened_at, days_open, amount_at_risk, description
FROM fact WHERE break_type IN ('timing_break', 'overpayment', 'coverage_exceeded') AND severity IN ('high', 'medium')
"""


_ROLLUP = f"""
SELECT break_type, severity, {_BUCKET} ELSE '{OLDEST_BUCKET}' END AS aging_bucket, merchant_id,
       count(*) AS breaks, CAST(sum(amount_at_risk) AS DECIMAL(34,2)) AS amount_at_risk,
       CAST(sum(days_open) AS BIGINT) AS days_open, count(days_open) AS dated, max(days_open) AS longest_open
FROM fact GROUP BY ALL"""

_CORRECTED = (
    "SELECT * REPLACE (CASE WHEN severity = 'high' THEN 'rechecked' ELSE description END AS description) FROM ("
    + _day(DAY_BEFORE, "earlier")
    + ") UNION ALL "
    + _day(AS_OF)
)


def _placed(report: str, order: str) -> str:
    return f"SELECT *, row_number() OVER (ORDER BY {order}) AS position FROM ({report})"


_RUN_TABLES = {
    "merchants": "merchants", "servicers": "servicers", "merchant_sales": "sales", "contracts": "contracts",
    "claims": "claims", "servicer_reimbursements": "payments", "stg_merchant_sales": "sales",
    "stg_contracts": "contracts", "stg_claims": "claims", "stg_servicer_reimbursements": "payments",
    "int_contract_lifecycle": "lc", "int_claim_lifecycle": "lk", "fct_recon_breaks": "fact",
    "fct_daily_break_snapshot": "fact", "break_aging": f"({_AGING})", "merchant_scorecard": f"({_SCORECARD})",
}
_RUN = " UNION ALL ".join(
    [f"SELECT '{name}' AS name, count(*) AS value FROM {view}" for name, view in _RUN_TABLES.items()]
    + [
        f"SELECT 'checks_{status}', count(*) FROM ({_checks()}) WHERE status = '{status}'"
        for status in ("pass", "fail")
    ]
)


def _on(models: str, **selects: str) -> dict[str, str]:
    return {name: f"WITH {models}\n{sql}" for name, sql in selects.items()}


def oracle_sql() -> dict[str, str]:
    detectors = {name: sql.replace("{as_of}", AS_OF) for name, sql in _DETECTORS.items()}
    two_days = f"{_FACT}, earlier AS ({_fact(DAY_BEFORE)})"
    return (
        _on(
            _FEEDS,
            src_scan=_SRC_SCAN,
            csv_roundtrip="SELECT * FROM sales",
            truth_scan="SELECT *, CAST(NULL AS VARCHAR) AS reimbursement_id,"
            " 'planted ' || break_type AS detail FROM planted",
            stg_merchant_sales="SELECT * FROM sales",
            stg_contracts="SELECT * FROM contracts",
            stg_claims="SELECT * FROM claims",
            stg_reimbursements="SELECT * FROM payments",
            int_contract_lifecycle=_CONTRACT_LIFECYCLE,
            int_claim_lifecycle=_CLAIM_LIFECYCLE,
            merchant_totals=_MERCHANT_TOTALS,
            planted_counts="SELECT break_type, count(*) AS planted FROM planted GROUP BY break_type",
            truth_log_totals="SELECT count(*) AS planted, count(DISTINCT break_type) AS categories FROM planted",
            merchant_sales_range="SELECT * FROM sales WHERE merchant_id = 'M007'"
            " AND sale_date >= DATE '1996-01-01' AND sale_date <= DATE '1998-12-31'",
            servicer_claims="SELECT * FROM claims WHERE servicer_id = 'S3' AND status = 'approved'",
            dq_unique="SELECT claim_id AS value, count(*) AS occurrences FROM payments"
            " GROUP BY claim_id HAVING count(*) > 1",
            dq_relationships="SELECT * FROM claims f"
            " WHERE NOT EXISTS (SELECT 1 FROM contracts k WHERE k.contract_id = f.contract_id)",
            dq_singular_coverage=_OVER_COVERAGE,
        )
        | _on(
            _MODELS,
            json_roundtrip=_ORPHAN_CLAIM,
            contract_payouts=_PAYOUTS,
            **detectors,
            contract_detail="SELECT * FROM lc WHERE contract_id = '742'",
            dq_not_null="SELECT * FROM (" + " UNION ALL ".join(
                f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS null_rows FROM lk"
                for c in ["claim_id", "reimbursement_id", "paid_date", "paid_amount",
                          "matched_contract_id", "coverage_limit", "is_overpayment"]
            ) + ") WHERE null_rows > 0",
        )
        | _on(
            _FACT,
            fct_recon_breaks="SELECT * FROM fact",
            materialize_breaks="SELECT * FROM fact",
            all_breaks="SELECT break_type, severity, entity_id, entity_type, merchant_id, servicer_id,"
            " opened_at, amount_at_risk, description FROM fact",
            break_key="SELECT break_key, opened_at, entity_id, break_type FROM fact",
            days_open="SELECT break_type, entity_id, opened_at, days_open FROM fact",
            break_descriptions="SELECT break_type, entity_id, description FROM fact",
            break_aging=_AGING,
            aging_report=_AGING,
            break_aging_order=_placed(_AGING, "CASE severity WHEN 'high' THEN 1 WHEN 'medium' THEN 2 ELSE 3 END,"
                                              " break_type, aging_bucket"),
            aging_report_order=_placed(_AGING, "severity, break_type, aging_bucket"),
            merchant_scorecard_order=_placed(_SCORECARD, "total_breaks DESC, merchant_id"),
            pipeline_summary=_RUN,
            kpi_summary="SELECT count(*) AS total_breaks,"
            " count(*) FILTER (severity = 'high') AS high_severity,"
            " CAST(sum(amount_at_risk) AS DECIMAL(34,2)) AS total_amount_at_risk,"
            " round(avg(days_open), 1) AS avg_days_open FROM fact",
            break_type_summary="SELECT break_type, count(*) AS breaks,"
            " CAST(sum(amount_at_risk) AS DECIMAL(34,2)) AS amount_at_risk"
            " FROM fact GROUP BY break_type",
            break_filter_values="SELECT DISTINCT 'break_type' AS filter, break_type AS value FROM fact"
            " UNION ALL SELECT DISTINCT 'severity', severity FROM fact",
            break_drilldown=_DRILLDOWN,
            break_drilldown_order="SELECT * EXCLUDE (break_key), row_number() OVER (ORDER BY severity, days_open DESC,"
            f" break_key) AS position FROM ({_DRILLDOWN.replace('description', 'description, break_key')})",
            break_rollup=_ROLLUP,
            snapshot_not_captured=_day("2001-08-02"),
            break_report="SELECT * FROM fact"
            " WHERE merchant_id = 'M001' AND break_type IN ('amount_break', 'timing_break')",
            detected_counts="SELECT break_type, count(*) AS detected FROM fact GROUP BY break_type",
            merchant_breaks=_MERCHANT_BREAKS,
            merchant_scorecard=_SCORECARD,
            truth_validation=_TRUTH,
            truth_regressions=f"SELECT * FROM ({_TRUTH}) WHERE detected < planted",
            daily_snapshot_full=_day("2001-08-02"),
            snapshot_schema_evolution=_day(DAY_BEFORE, extra=", CAST(NULL AS VARCHAR) AS counterparty")
            + " UNION ALL "
            + _day(AS_OF, extra=", coalesce(merchant_id, servicer_id) AS counterparty"),
            dq_accepted_values="SELECT severity AS value, count(*) AS occurrences FROM fact"
            " WHERE severity NOT IN ('medium', 'low') GROUP BY severity",
            dq_results=_checks(),
            dq_summary=f"SELECT status, count(*) AS checks FROM ({_checks()}) GROUP BY status",
        )
        | _on(
            two_days,
            daily_snapshot_incremental=f"{_day(DAY_BEFORE, 'earlier')} UNION ALL {_day(AS_OF)}",
            # Day one again (replaced, key by key) and day two (added).
            snapshot_delete_insert=_CORRECTED,
            snapshot_correct=_CORRECTED,
        )
    )
