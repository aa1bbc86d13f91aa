"""Whole-pipeline plans: reports, data-quality checks and the pipeline itself."""

from tripartite.plans.pipeline import (
    PipelineRun,
    build_breaks,
    build_fact,
    build_facts,
    feed_counts,
    land_feeds,
    lay_out_feeds,
    lifecycle_views,
    lifecycles,
    pipeline_summary,
    run_pipeline,
    stage_counted,
)
from tripartite.plans.quality import (
    QualityError,
    accepted_values,
    assert_quality,
    dq_summary,
    not_null,
    over_coverage,
    relationships,
    reimbursement_within_coverage,
    run_checks,
    unique,
)
from tripartite.plans.reports import (
    aging_report,
    break_aging,
    break_drilldown,
    break_drilldown_pages,
    break_filter_values,
    break_report,
    break_rollup,
    break_type_summary,
    contract_detail,
    detected_counts,
    kpi_summary,
    merchant_breaks,
    merchant_sales_range,
    merchant_scorecard,
    merchant_totals,
    planted_counts,
    servicer_claims,
    truth_log_totals,
    truth_regressions,
    truth_validation,
)

__all__ = [
    "PipelineRun",
    "QualityError",
    "accepted_values",
    "aging_report",
    "assert_quality",
    "break_aging",
    "break_drilldown",
    "break_drilldown_pages",
    "break_filter_values",
    "break_report",
    "break_rollup",
    "break_type_summary",
    "build_breaks",
    "build_fact",
    "build_facts",
    "contract_detail",
    "detected_counts",
    "dq_summary",
    "feed_counts",
    "kpi_summary",
    "land_feeds",
    "lay_out_feeds",
    "lifecycle_views",
    "lifecycles",
    "merchant_breaks",
    "merchant_sales_range",
    "merchant_scorecard",
    "merchant_totals",
    "not_null",
    "over_coverage",
    "pipeline_summary",
    "planted_counts",
    "reimbursement_within_coverage",
    "relationships",
    "run_checks",
    "run_pipeline",
    "servicer_claims",
    "stage_counted",
    "truth_log_totals",
    "truth_regressions",
    "truth_validation",
    "unique",
]
