"""Reports over the fact or its rollup, the staged tables and the truth log.

Every aggregate here has partial results per map task, so a hot merchant or break
type costs one row per task in the shuffle. The one sort of break rows ends on the
unique break key, so its ranges can cut through equal leading values.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripartite.functions import aging_bucket, percent_text, ratio, severity_rank
from tripartite.operators.lifecycle import contract_lifecycle
from tripartite.operators.numbering import number_rows
from tripartite.schemas import MONEY_REPORT


def _rows(name: str) -> Column:
    return F.count("*").alias(name)


# ---- the rollup ----------------------------------------------------------------

# Columns of the rollup, and what they add up to over groups of it.
_ROLLUP_KEYS = ["break_type", "severity", "aging_bucket", "merchant_id"]
_ADDED = {
    "breaks": "sum(breaks)",
    "amount_at_risk": f"cast(sum(amount_at_risk) as {MONEY_REPORT})",
    "days_open": "sum(days_open)",
    "dated": "sum(dated)",
    "longest_open": "max(longest_open)",
}


def _additive(breaks: DataFrame) -> DataFrame:
    """A rollup as it is; of a fact, each break as a rollup row of its own."""
    if "longest_open" in breaks.columns:
        return breaks
    return breaks.selectExpr(
        "break_type", "severity", f"{aging_bucket('days_open')} as aging_bucket", "merchant_id",
        "1L as breaks", "amount_at_risk", "bigint(days_open) as days_open",
        "if(days_open is null, 0L, 1L) as dated", "days_open as longest_open",
    )


def break_rollup(fact: DataFrame) -> DataFrame:
    """Sums of the breaks by type, severity, age bucket and merchant: a table as small as
    these have values, from one pass over the fact. Every report over breaks as a whole
    takes it in place of the fact and adds up its rows."""
    added = [F.expr(expression).alias(name) for name, expression in _ADDED.items()]
    return _additive(fact).groupBy(*_ROLLUP_KEYS).agg(*added)


def _count(name: str, condition: str = "true") -> Column:
    return F.expr(f"coalesce(sum(if({condition}, breaks, 0L)), 0L) as {name}")


def _total(name: str) -> Column:
    return F.expr(f"cast(round(sum(amount_at_risk), 2) as {MONEY_REPORT}) as {name}")


def _mean_days(name: str) -> Column:
    return F.expr(f"round(sum(days_open) / nullif(sum(dated), 0), 1) as {name}")


# ---- fact reports ------------------------------------------------------------


def break_aging(breaks: DataFrame) -> DataFrame:
    """Breaks per type, severity and age bucket, most severe first."""
    return (
        _additive(breaks).groupBy("break_type", "severity", "aging_bucket")
        .agg(
            _count("break_count"),
            _total("total_amount_at_risk"),
            _mean_days("avg_days_open"),
            F.max("longest_open").alias("max_days_open"),
        )
        .orderBy(F.expr(severity_rank("severity")), "break_type", "aging_bucket")
    )


def aging_report(aging: DataFrame) -> DataFrame:
    """The ageing table sorted by its labels."""
    return aging.orderBy("severity", "break_type", "aging_bucket")


def kpi_summary(breaks: DataFrame) -> DataFrame:
    """One row of headline numbers."""
    return _additive(breaks).agg(
        _count("total_breaks"),
        _count("high_severity", "severity = 'high'"),
        _total("total_amount_at_risk"),
        _mean_days("avg_days_open"),
    )


def break_type_summary(breaks: DataFrame, limit: int | None = None) -> DataFrame:
    """Count and amount of every break type by name; ``limit`` shows the first ones only."""
    summary = (
        _additive(breaks).groupBy("break_type")
        .agg(_count("breaks"), _total("amount_at_risk"))
        .orderBy("break_type")
    )
    return summary if limit is None else summary.limit(limit)


def break_filter_values(breaks: DataFrame) -> DataFrame:
    """Distinct break types and severities, from one pass over their pairs."""
    pairs = breaks.select("break_type", "severity").distinct()
    named = F.array(
        *[F.struct(F.lit(c).alias("filter"), F.col(c).alias("value")) for c in pairs.columns]
    )
    return pairs.select(F.inline(named)).distinct().orderBy("filter", "value")


def _drilldown(fact: DataFrame, break_types: Sequence[str], severities: Sequence[str]) -> DataFrame:
    return fact.where(
        F.col("break_type").isin(list(break_types)) & F.col("severity").isin(list(severities))
    ).select(
        "break_type",
        "severity",
        "entity_type",
        "entity_id",
        F.coalesce("merchant_id", "servicer_id").alias("counterparty"),
        "opened_at",
        "days_open",
        "amount_at_risk",
        "description",
        "break_key",
    )


def _by_severity_and_age() -> list[Column]:
    return [F.col("severity").asc(), F.col("days_open").desc(), F.col("break_key").asc()]


def break_drilldown(
    fact: DataFrame, break_types: Sequence[str], severities: Sequence[str]
) -> DataFrame:
    """Breaks of the selected types and severities by severity, oldest first; empty if
    nothing is selected."""
    found = _drilldown(fact, break_types, severities)
    return found.orderBy(*_by_severity_and_age()).drop("break_key")


def break_drilldown_pages(
    fact: DataFrame, break_types: Sequence[str], severities: Sequence[str], work: str | None = None
) -> DataFrame:
    """:func:`break_drilldown` with each row's ``position``, so that a page of any size can
    be read by it; two tables are written, as for the break keys."""
    found = _drilldown(fact, break_types, severities)
    return number_rows(found, _by_severity_and_age(), "position", work).drop("break_key")


def break_report(
    fact: DataFrame, merchant_id: str, as_of: date, break_types: Sequence[str]
) -> DataFrame:
    """One merchant's breaks of the given types in the fact built for ``as_of``.

    A fact built for another day has no rows of ``as_of``, so the report is empty.
    """
    return fact.where(
        (F.col("merchant_id") == merchant_id)
        & (F.col("as_of_date") == F.lit(as_of))
        & F.col("break_type").isin(list(break_types))
    )


# ---- merchant scorecard --------------------------------------------------------


def merchant_totals(contracts: DataFrame) -> DataFrame:
    """Contracts and premium per merchant.

    The distinct count is taken over (merchant, contract) first, so a hot merchant
    is spread by contract before its single row is formed.
    """
    return contracts.groupBy("merchant_id").agg(
        F.count_distinct("contract_id").alias("total_contracts"),
        F.sum("premium").cast(MONEY_REPORT).alias("total_premium_expected"),
    )


def merchant_breaks(breaks: DataFrame) -> DataFrame:
    """Breaks per merchant, in total and for three of the types."""
    return (
        _additive(breaks).where(F.col("merchant_id").isNotNull())
        .groupBy("merchant_id")
        .agg(
            _count("total_breaks"),
            F.expr(f"cast(sum(amount_at_risk) as {MONEY_REPORT}) as total_amount_at_risk"),
            _count("timing_breaks", "break_type = 'timing_break'"),
            _count("amount_breaks", "break_type = 'amount_break'"),
            _count("orphan_contracts", "break_type = 'orphan_contract'"),
        )
    )


def merchant_scorecard(breaks: DataFrame, merchants: DataFrame, contracts: DataFrame) -> DataFrame:
    """Every merchant with its contracts and breaks; zeros where it has none."""
    joined = merchants.join(merchant_totals(contracts), "merchant_id", "left").join(
        merchant_breaks(breaks), "merchant_id", "left"
    )
    rate = ratio("total_breaks", "total_contracts", 3)
    return (
        joined.na.fill(0, [c for c in joined.columns if c not in merchants.columns])
        .selectExpr(
            "merchant_id",
            "merchant_name",
            "category",
            "total_contracts",
            "total_premium_expected",
            "total_breaks",
            "total_amount_at_risk",
            "timing_breaks",
            "amount_breaks",
            "orphan_contracts",
            f"{rate} as break_rate",
        )
        .orderBy(F.col("total_breaks").desc(), "merchant_id")
    )


# ---- ground truth ----------------------------------------------------------------


def detected_counts(breaks: DataFrame) -> DataFrame:
    return _additive(breaks).groupBy("break_type").agg(_count("detected"))


def planted_counts(truth: DataFrame) -> DataFrame:
    return truth.groupBy("break_type").agg(_rows("planted"))


def truth_log_totals(truth: DataFrame) -> DataFrame:
    """Size of the truth log and number of categories in it."""
    return truth.agg(_rows("planted"), F.count_distinct("break_type").alias("categories"))


def truth_validation(breaks: DataFrame, truth: DataFrame) -> DataFrame:
    """Planted against detected per type, with the share that was caught."""
    return (
        planted_counts(truth)
        .join(detected_counts(breaks), "break_type", "full")
        .na.fill(0, ["planted", "detected"])
        .selectExpr(
            "break_type",
            "planted",
            "detected",
            f"{percent_text('detected', 'planted')} as catch_rate",
        )
        .orderBy("break_type")
    )


def truth_regressions(breaks: DataFrame, truth: DataFrame) -> DataFrame:
    """Types detected less often than planted."""
    return truth_validation(breaks, truth).where(F.col("detected") < F.col("planted"))


# ---- lookups on the staged tables ----------------------------------------------------


def merchant_sales_range(
    sales: DataFrame, merchant_id: str, from_date: date, to_date: date
) -> DataFrame:
    """A merchant's sales between two dates, both included."""
    return sales.where(
        (F.col("merchant_id") == merchant_id) & F.col("sale_date").between(from_date, to_date)
    )


def contract_detail(contracts: DataFrame, sales: DataFrame, contract_id: str) -> DataFrame:
    """One contract with its sale. The id reaches the scan of the contracts, and only the
    sale it names leaves the scan of the sales: contract ids are unique, so it is one sale
    id that is broadcast, and the other sales are not shuffled."""
    found = contracts.where(F.col("contract_id") == contract_id)
    named = F.broadcast(found.select("sale_id").distinct())
    return contract_lifecycle(found, sales.join(named, "sale_id", "left_semi"))


def servicer_claims(claims: DataFrame, servicer_id: str, status: str = "approved") -> DataFrame:
    return claims.where((F.col("servicer_id") == servicer_id) & (F.col("status") == status))
