"""Queries of this library on the order-processing tables, and their DuckDB oracles.

Every query reads its feeds through ``tripartite.sources.tpch``. What a query writes on
the way goes to the shared folder; run it inside ``sources.workspace(spark)`` to have that
removed at the end.
"""

from __future__ import annotations

import importlib
import os
import sys
from collections.abc import Callable
from datetime import date
from functools import partial

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import oracles  # noqa: E402
from tripartite import operators as op  # noqa: E402
from tripartite import plans, sources, tune  # noqa: E402
from tripartite.schemas import BREAK_SCHEMA, RAW_SCHEMAS  # noqa: E402
from tripartite.session import together  # noqa: E402
from tripartite.sources import tpch  # noqa: E402
from tripartite.sources.scratch import scratch_path  # noqa: E402

AS_OF = tpch.AS_OF
DAY_BEFORE = date(2001, 7, 31)
DAY_AFTER = date(2001, 8, 2)

Query = Callable[[SparkSession, str], DataFrame]


def _optional(name: str):
    """A module that may have been left out; an error inside one that is there is raised."""
    try:
        return importlib.import_module(name)
    except ModuleNotFoundError as missing:
        if missing.name and (name == missing.name or name.startswith(f"{missing.name}.")):
            return None
        raise


_llm = _optional("tripartite.llm.queries")
_corpus = _optional("corpus_pipeline") if _llm else None


FOR_CONTRACTS = ["contracts", "merchant_sales"]
FOR_CLAIMS = ["claims", "servicer_reimbursements", "contracts"]
FOR_BREAKS = ["contracts", "merchant_sales", "claims", "servicer_reimbursements"]


def _raw(spark: SparkSession, root: str, *feeds: str) -> dict[str, DataFrame]:
    return tpch.raw_sources(tune(spark), root, feeds)


def _staged(spark: SparkSession, root: str, *feeds: str) -> dict[str, DataFrame]:
    return op.stage_all(_raw(spark, root, *feeds))


def _stage(feed: str) -> Query:
    return lambda spark, root: _staged(spark, root, feed)[f"stg_{feed}"]


def _contract_lifecycle(spark: SparkSession, root: str) -> DataFrame:
    """Lazy: a query on one lifecycle alone needs no written table."""
    staged = _staged(spark, root, *FOR_CONTRACTS)
    return op.contract_lifecycle(staged["stg_contracts"], staged["stg_merchant_sales"])


def _claim_lifecycle(spark: SparkSession, root: str) -> DataFrame:
    staged = _staged(spark, root, *FOR_CLAIMS)
    return op.claim_lifecycle(
        staged["stg_claims"], staged["stg_servicer_reimbursements"], staged["stg_contracts"]
    )


def _breaks(spark: SparkSession, root: str, as_of: date = AS_OF) -> DataFrame:
    """The fact without its key, which the aggregating reports do not need."""
    return plans.build_breaks(_staged(spark, root, *FOR_BREAKS), as_of)


def _fact(spark: SparkSession, root: str, as_of: date = AS_OF) -> DataFrame:
    return plans.build_fact(_staged(spark, root, *FOR_BREAKS), as_of)


def _facts(spark: SparkSession, root: str, *days: date) -> list[DataFrame]:
    return plans.build_facts(_staged(spark, root, *FOR_BREAKS), days)


def _truth(spark: SparkSession, root: str) -> DataFrame:
    return tpch.planted_breaks(tune(spark), root)


# ---- sources and sinks -----------------------------------------------------------


def _src_scan(spark: SparkSession, root: str) -> DataFrame:
    """Rows and filled fields of each feed, read back from CSV."""
    folder = scratch_path(spark, "feeds")
    together(
        spark,
        *[
            partial(sources.write_csv, df, f"{folder}/{name}.csv")
            for name, df in _raw(spark, root, *RAW_SCHEMAS).items()
        ],
    )
    scanned = None
    for name, df in sources.read_raw_sources(spark, folder).items():
        filled = [F.count(F.nullif(F.col(c), F.lit(""))) for c in df.columns]
        row = df.agg(
            F.count(F.lit(1)).alias("row_count"), sum(filled[1:], filled[0]).alias("filled_fields")
        ).select(F.lit(name).alias("source_table"), "row_count", "filled_fields")
        scanned = row if scanned is None else scanned.unionByName(row)
    return scanned


def _csv_roundtrip(spark: SparkSession, root: str) -> DataFrame:
    path = scratch_path(spark, "merchant_sales.csv")
    sources.write_csv(_raw(spark, root, "merchant_sales")["merchant_sales"], path)
    return op.stage_merchant_sales(sources.read_raw_csv(spark, path, "merchant_sales"))


def _json_roundtrip(spark: SparkSession, root: str) -> DataFrame:
    path = scratch_path(spark, "orphan_claims.json")
    sources.write_json(_detect_orphan_claim(spark, root), path)
    return spark.read.schema(BREAK_SCHEMA).json(path)


def _truth_scan(spark: SparkSession, root: str) -> DataFrame:
    """The truth log, one object per line; an object has only the keys it needs."""
    path = scratch_path(spark, "planted_breaks.json")
    sources.write_json(_truth(spark, root), path)
    return sources.read_truth(spark, path, array=False)


def _materialize_breaks(spark: SparkSession, root: str) -> DataFrame:
    path = scratch_path(spark, "fct_recon_breaks")
    sources.write_fact(_fact(spark, root), path)
    return sources.read_fact(spark, path)


def _snapshot_incremental(spark: SparkSession, root: str) -> DataFrame:
    """Two days, and the first of them captured again to no effect."""
    path = scratch_path(spark, "fct_daily_break_snapshot")
    earlier, fact = _facts(spark, root, DAY_BEFORE, AS_OF)
    sources.snapshot_breaks(earlier, path, DAY_BEFORE)
    sources.snapshot_breaks(fact, path, DAY_BEFORE)
    sources.snapshot_breaks(fact, path, AS_OF)
    return sources.read_snapshot(spark, path)


def _snapshot_full(spark: SparkSession, root: str) -> DataFrame:
    """A history of one day replaced by another day."""
    path = scratch_path(spark, "fct_daily_break_snapshot")
    fact = _fact(spark, root)
    sources.snapshot_breaks(fact, path, AS_OF)
    sources.snapshot_breaks(fact, path, DAY_AFTER, full_refresh=True)
    return sources.read_snapshot(spark, path)


def _snapshot_evolution(spark: SparkSession, root: str) -> DataFrame:
    """The second day brings a column the first does not have."""
    path = scratch_path(spark, "fct_daily_break_snapshot")
    fact = _fact(spark, root)
    sources.snapshot_breaks(fact, path, DAY_BEFORE)
    wider = fact.withColumn("counterparty", F.coalesce("merchant_id", "servicer_id"))
    sources.snapshot_breaks(wider, path, AS_OF)
    return sources.read_snapshot(spark, path)


def _delete_insert(spark: SparkSession, root: str) -> DataFrame:
    """Day one's high breaks corrected and day two added, by (snapshot_date, break_key)."""
    earlier, fact = _facts(spark, root, DAY_BEFORE, AS_OF)
    first = sources.snapshot_rows(earlier, DAY_BEFORE)
    corrected = first.where(F.col("severity") == "high").withColumn(
        "description", F.lit("rechecked")
    )
    new = corrected.unionByName(sources.snapshot_rows(fact, AS_OF))
    return sources.delete_insert(first, new, ["snapshot_date", "break_key"])


def _snapshot_correct(spark: SparkSession, root: str) -> DataFrame:
    """The same on the stored history: day one is rewritten, day two is new."""
    path = scratch_path(spark, "fct_daily_break_snapshot")
    earlier, fact = _facts(spark, root, DAY_BEFORE, AS_OF)
    sources.snapshot_breaks(earlier, path, DAY_BEFORE)
    first = sources.read_snapshot(spark, path)
    corrected = first.where(F.col("severity") == "high").withColumn(
        "description", F.lit("rechecked")
    )
    new = corrected.unionByName(sources.snapshot_rows(fact, AS_OF))
    sources.correct_snapshot(spark, path, new, ["snapshot_date", "break_key"])
    return sources.read_snapshot(spark, path)


def _not_captured(spark: SparkSession, root: str) -> DataFrame:
    """The rows of two days of which the history has one."""
    path = scratch_path(spark, "fct_daily_break_snapshot")
    fact = _fact(spark, root)
    sources.snapshot_breaks(fact, path, AS_OF)
    both = sources.snapshot_rows(fact, AS_OF).unionByName(sources.snapshot_rows(fact, DAY_AFTER))
    return sources.not_captured(both, sources.captured_dates(spark, path))


def _pipeline_summary(spark: SparkSession, root: str) -> DataFrame:
    """The whole run, its tables counted. The fixture breaks the invariant, so no gate."""
    run = plans.run_pipeline(
        _raw(spark, root, *RAW_SCHEMAS), scratch_path(spark, "run"), AS_OF, AS_OF, gate=False
    )
    return plans.pipeline_summary(run)


def _placed(report: DataFrame) -> DataFrame:
    """A report of a few rows with the place of each."""
    return report.coalesce(1).withColumn("position", F.monotonically_increasing_id() + 1)


# ---- detectors ----------------------------------------------------------------------


def _detect_orphan_claim(spark: SparkSession, root: str) -> DataFrame:
    staged = _staged(spark, root, "claims", "contracts")
    filed = op.claims_with_contract(staged["stg_claims"], staged["stg_contracts"])
    return op.detect_orphan_claim(filed)


def _paid_claims(spark: SparkSession, root: str) -> DataFrame:
    staged = _staged(spark, root, "claims", "servicer_reimbursements")
    return op.paid_claims(staged["stg_claims"], staged["stg_servicer_reimbursements"])


def _detect_coverage_exceeded(spark: SparkSession, root: str) -> DataFrame:
    terms = op.contract_terms(_stage("contracts")(spark, root))
    return op.detect_coverage_exceeded(terms, _paid_claims(spark, root))


def _all_breaks(spark: SparkSession, root: str) -> DataFrame:
    """Over the lifecycles, each a view that is read as often as it says."""
    both = plans.lifecycles(_staged(spark, root, *FOR_BREAKS), grouped=True)
    return op.all_breaks(
        both["int_contract_lifecycle"], both["int_claim_lifecycle"], AS_OF, dealt=op.BY_CLAIM
    )


# ---- reports and checks ----------------------------------------------------------------


def _merchant_scorecard(spark: SparkSession, root: str) -> DataFrame:
    raw = _raw(spark, root, "merchants", *FOR_BREAKS)
    staged = op.stage_all(raw)
    breaks = plans.build_breaks(staged, AS_OF)
    return plans.merchant_scorecard(breaks, raw["merchants"], staged["stg_contracts"])


def _dq_results(spark: SparkSession, root: str) -> DataFrame:
    """All declared checks on the feeds, the staged tables, the fact and one snapshot.

    Nulls and values out of the lists are counted while the feeds and the fact are written.
    """
    landed = plans.land_feeds(_raw(spark, root, *RAW_SCHEMAS), scratch_path(spark, "feeds"))
    raw = {name: feed.rows for name, feed in landed.items()}
    staged = op.stage_all(raw)
    version, counted = plans.stage_counted(
        plans.build_fact(staged, AS_OF), scratch_path(spark, "fct_recon_breaks"), AS_OF
    )
    fact = version.read()
    marts = {
        "fct_recon_breaks": fact,
        "fct_daily_break_snapshot": sources.snapshot_rows(fact, AS_OF),
    }
    counted |= plans.feed_counts(landed)
    return plans.run_checks(raw | staged | marts, invariant_on=staged, counted=counted)


def _dq_not_null(spark: SparkSession, root: str) -> DataFrame:
    return plans.not_null(
        _claim_lifecycle(spark, root),
        "claim_id", "reimbursement_id", "paid_date", "paid_amount", "matched_contract_id",
        "coverage_limit", "is_overpayment",
    )


def _dq_relationships(spark: SparkSession, root: str) -> DataFrame:
    staged = _staged(spark, root, "claims", "contracts")
    return plans.relationships(
        staged["stg_claims"], staged["stg_contracts"], "contract_id", "contract_id"
    )


def _dq_singular_coverage(spark: SparkSession, root: str) -> DataFrame:
    staged = _staged(spark, root, *FOR_CLAIMS)
    return plans.reimbursement_within_coverage(
        staged["stg_servicer_reimbursements"], staged["stg_claims"], staged["stg_contracts"]
    )


def _contract_detail(spark: SparkSession, root: str) -> DataFrame:
    staged = _staged(spark, root, *FOR_CONTRACTS)
    return plans.contract_detail(staged["stg_contracts"], staged["stg_merchant_sales"], "742")


# ---- driver contract --------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """The fact: every break in the smallest data set, numbered."""
    return _fact(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    return {
        # sources and sinks
        "src_scan": _src_scan,
        "csv_roundtrip": _csv_roundtrip,
        "json_roundtrip": _json_roundtrip,
        "truth_scan": _truth_scan,
        "materialize_breaks": _materialize_breaks,
        "daily_snapshot_incremental": _snapshot_incremental,
        "daily_snapshot_full": _snapshot_full,
        "snapshot_schema_evolution": _snapshot_evolution,
        "snapshot_delete_insert": _delete_insert,
        "snapshot_correct": _snapshot_correct,
        "snapshot_not_captured": _not_captured,
        "pipeline_summary": _pipeline_summary,
        # staging and lifecycles
        "stg_merchant_sales": _stage("merchant_sales"),
        "stg_contracts": _stage("contracts"),
        "stg_claims": _stage("claims"),
        "stg_reimbursements": _stage("servicer_reimbursements"),
        "int_contract_lifecycle": lambda s, d: _contract_lifecycle(s, d),
        "int_claim_lifecycle": lambda s, d: _claim_lifecycle(s, d),
        # detectors and fact
        "detect_orphan_contract": lambda s, d: op.detect_orphan_contract(
            _contract_lifecycle(s, d)
        ),
        "detect_timing_break": lambda s, d: op.detect_timing_break(
            _contract_lifecycle(s, d), AS_OF
        ),
        "detect_amount_break": lambda s, d: op.detect_amount_break(_contract_lifecycle(s, d)),
        "detect_orphan_claim": _detect_orphan_claim,
        "detect_duplicate_claim": lambda s, d: op.detect_duplicate_claim(_paid_claims(s, d)),
        "detect_overpayment": lambda s, d: op.detect_overpayment(_paid_claims(s, d)),
        "detect_coverage_exceeded": _detect_coverage_exceeded,
        "contract_payouts": lambda s, d: op.contract_payouts(_paid_claims(s, d)),
        "all_breaks": _all_breaks,
        "break_key": lambda s, d: _fact(s, d).select(
            "break_key", "opened_at", "entity_id", "break_type"
        ),
        "days_open": lambda s, d: _breaks(s, d).select(
            "break_type", "entity_id", "opened_at", "days_open"
        ),
        "break_descriptions": lambda s, d: _breaks(s, d).select(
            "break_type", "entity_id", "description"
        ),
        "fct_recon_breaks": _fact,
        # reports
        "break_aging": lambda s, d: plans.break_aging(_breaks(s, d)),
        "aging_report": lambda s, d: plans.aging_report(plans.break_aging(_breaks(s, d))),
        "break_aging_order": lambda s, d: _placed(plans.break_aging(_breaks(s, d))),
        "aging_report_order": lambda s, d: _placed(
            plans.aging_report(plans.break_aging(_breaks(s, d)))
        ),
        "merchant_scorecard_order": lambda s, d: _placed(_merchant_scorecard(s, d)),
        "kpi_summary": lambda s, d: plans.kpi_summary(_breaks(s, d)),
        "break_type_summary": lambda s, d: plans.break_type_summary(_breaks(s, d)),
        "break_filter_values": lambda s, d: plans.break_filter_values(_breaks(s, d)),
        "break_drilldown": lambda s, d: plans.break_drilldown(
            _fact(s, d),
            ["timing_break", "overpayment", "coverage_exceeded"],
            ["high", "medium"],
        ),
        "break_drilldown_order": lambda s, d: plans.break_drilldown_pages(
            _fact(s, d),
            ["timing_break", "overpayment", "coverage_exceeded"],
            ["high", "medium"],
        ),
        "break_rollup": lambda s, d: plans.break_rollup(_breaks(s, d)),
        "break_report": lambda s, d: plans.break_report(
            _fact(s, d), "M001", AS_OF, ["amount_break", "timing_break"]
        ),
        "detected_counts": lambda s, d: plans.detected_counts(_breaks(s, d)),
        "merchant_totals": lambda s, d: plans.merchant_totals(_stage("contracts")(s, d)),
        "merchant_breaks": lambda s, d: plans.merchant_breaks(_breaks(s, d)),
        "merchant_scorecard": _merchant_scorecard,
        "merchant_sales_range": lambda s, d: plans.merchant_sales_range(
            _stage("merchant_sales")(s, d), "M007", date(1996, 1, 1), date(1998, 12, 31)
        ),
        "contract_detail": _contract_detail,
        "servicer_claims": lambda s, d: plans.servicer_claims(_stage("claims")(s, d), "S3"),
        # ground truth
        "planted_counts": lambda s, d: plans.planted_counts(_truth(s, d)),
        "truth_log_totals": lambda s, d: plans.truth_log_totals(_truth(s, d)),
        "truth_validation": lambda s, d: plans.truth_validation(_breaks(s, d), _truth(s, d)),
        "truth_regressions": lambda s, d: plans.truth_regressions(_breaks(s, d), _truth(s, d)),
        # data quality
        "dq_not_null": _dq_not_null,
        "dq_unique": lambda s, d: plans.unique(
            _stage("servicer_reimbursements")(s, d), "claim_id"
        ),
        "dq_accepted_values": lambda s, d: plans.accepted_values(
            _breaks(s, d), "severity", ["medium", "low"]
        ),
        "dq_relationships": _dq_relationships,
        "dq_singular_coverage": _dq_singular_coverage,
        "dq_results": _dq_results,
        "dq_summary": lambda s, d: plans.dq_summary(_dq_results(s, d)),
        # text corpora
        **(_llm.QUERIES if _llm else {}),
        **({"pipeline": _corpus.run} if _corpus else {}),
    }


def oracle_sql() -> dict[str, str]:
    expected = oracles.oracle_sql() | (_llm.ORACLES if _llm else {})
    if _corpus and _corpus.ORACLE_SQL:
        expected["pipeline"] = _corpus.ORACLE_SQL
    return expected
