"""Raw feeds to fact, history, reports and checks in one call."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date
from functools import partial, reduce

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from tripartite.operators import (
    claim_breaks,
    claim_lifecycle,
    claims_with_contract,
    contract_breaks,
    contract_lifecycle,
    contract_terms,
    detect_orphan_claim,
    finish_breaks,
    paid_claims,
    stage_all,
)
from tripartite.operators.detect import (
    HIGH_AFTER_DAYS,
    SLA_DAYS,
    claim_marks,
    contract_marks,
    coverage_marks,
    lifecycle_marks,
    without_payouts,
)
from tripartite.operators.lifecycle import claims_with_few_payments, claims_with_payments
from tripartite.operators.numbering import keyed_facts
from tripartite.operators.staging import STAGED_FEEDS, typed
from tripartite.plans import quality, reports
from tripartite.session import RUNTIME_CONF, UNFOLDED, freed, sized, together, tuned, width
from tripartite.sources.layout import Keyed, Landed, by_parts, hot_keys, land, lay_out
from tripartite.sources.publish import Version, publish_table
from tripartite.sources.scratch import drop_folder, source_bytes, write_through
from tripartite.sources.tables import read_fact, read_snapshot, snapshot_breaks, stage_fact


@dataclass
class PipelineRun:
    """What a run produced: frames by table name, check counts by status, planted types
    that were not all detected, and the seconds it took.

    The frames of feeds, staged tables and lifecycles read the run's own ``work`` folder;
    no other run touches it, and :meth:`close` removes it when they are no longer needed.
    """

    tables: dict[str, DataFrame]
    snapshot_written: bool
    checks: dict[str, int] = field(default_factory=dict)
    regressions: list[Row] = field(default_factory=list)
    seconds: float = 0.0
    work: str = ""

    def close(self, spark: SparkSession) -> None:
        drop_folder(spark, self.work)


def lifecycles(staged: dict[str, DataFrame], grouped: bool = False) -> dict[str, DataFrame]:
    """Both lifecycle views, lazy; ``grouped`` as in :func:`claim_lifecycle`."""
    return {
        "int_contract_lifecycle": contract_lifecycle(
            staged["stg_contracts"], staged["stg_merchant_sales"]
        ),
        "int_claim_lifecycle": claim_lifecycle(
            staged["stg_claims"], staged["stg_servicer_reimbursements"], staged["stg_contracts"], grouped=grouped
        ),
    }


def build_breaks(
    staged: dict[str, DataFrame],
    as_of: date,
    sla_days: int = SLA_DAYS,
    high_after_days: int = HIGH_AFTER_DAYS,
) -> DataFrame:
    """Every break with its age, not numbered. Lazy over the staged tables, in one plan.

    Each group of rules has the join that it needs and no wider one: payments meet their
    claims, claims their contracts, contracts their sales. No lifecycle is formed or written.
    """
    sold = contract_lifecycle(staged["stg_contracts"], staged["stg_merchant_sales"])
    found = contract_breaks(sold, as_of, sla_days, high_after_days).unionByName(_breaks_of_claims(staged))
    return finish_breaks(found, as_of)


def _breaks_of_claims(staged: dict[str, DataFrame]) -> DataFrame:
    """Breaks that are the same on every day."""
    contracts, claims = staged["stg_contracts"], staged["stg_claims"]
    paid = paid_claims(claims, staged["stg_servicer_reimbursements"])
    return detect_orphan_claim(claims_with_contract(claims, contracts)).unionByName(
        claim_breaks(paid, contract_terms(contracts), dealt=True)
    )


def build_facts(
    staged: dict[str, DataFrame],
    days: Sequence[date],
    sla_days: int = SLA_DAYS,
    high_after_days: int = HIGH_AFTER_DAYS,
) -> list[DataFrame]:
    """The numbered fact as of each of several days.

    Breaks travel as marks. What claims tell is written once, where they meet payments and
    contracts; breaks go from there to the sort, payouts to the contracts. All days share one
    sort.
    """
    return _keyed_facts(staged, days, sla_days, high_after_days)


def build_fact(
    staged: dict[str, DataFrame],
    as_of: date,
    sla_days: int = SLA_DAYS,
    high_after_days: int = HIGH_AFTER_DAYS,
    work: str | None = None,
) -> DataFrame:
    """The numbered fact."""
    return _keyed_facts(staged, [as_of], sla_days, high_after_days, work)[0]


def _keyed_facts(
    staged: dict[str, DataFrame], days: Sequence[date], sla_days: int, high_after_days: int, work: str | None = None
) -> list[DataFrame]:
    contracts, claims = staged["stg_contracts"], staged["stg_claims"]
    paid = paid_claims(claims, staged["stg_servicer_reimbursements"])
    sold = contract_lifecycle(contracts, staged["stg_merchant_sales"])
    of_claims = claim_marks(claims_with_contract(claims, contracts), paid)
    return _numbered(of_claims, sold, contract_terms(contracts), days, sla_days, high_after_days, work)


def _numbered(
    of_claims: DataFrame,
    sold: DataFrame,
    terms: DataFrame,
    days: Sequence[date],
    sla_days: int,
    high_after_days: int,
    work: str | None = None,
) -> list[DataFrame]:
    """The facts from the marks of claims, the contract lifecycle and the terms of contracts."""
    at = (f"{work}/claim_breaks",) if work else ()
    of_claims = write_through(of_claims, "claim_breaks", *at)
    of_contracts = contract_marks(sold, max(days), sla_days).unionByName(coverage_marks(of_claims, terms))
    return keyed_facts(of_contracts, without_payouts(of_claims), days, sla_days, high_after_days, work)


# Columns on which feeds meet: the fewest copies of each feed that give every join between
# them its layout. Claims meet contracts first; with their contract they meet payments.
_JOIN_KEYS = {
    "merchant_sales": ["sale_id"],
    "contracts": ["sale_id", "contract_id"],
    "claims": ["contract_id", "claim_id"],
    "servicer_reimbursements": ["claim_id"],
}


def _counts(feed: str) -> dict[str, str]:
    """What is counted while a feed is landed: its checks and those of its staged form."""
    counts = quality.counted_while_writing(feed)
    if feed in STAGED_FEEDS:
        counts |= quality.counted_while_writing(f"stg_{feed}", typed(feed))
    return counts


def land_feeds(raw: dict[str, DataFrame], root: str) -> dict[str, Landed]:
    """The feeds written once below ``root``, with the counts that checks and layout need."""
    spark = raw["contracts"].sparkSession
    size = source_bytes(*raw.values())
    with tuned(spark, sized(spark, size * UNFOLDED)):
        return land(raw, root, {feed: _counts(feed) for feed in raw}, _JOIN_KEYS, width(spark, size * UNFOLDED))


def feed_counts(landed: dict[str, Landed]) -> dict[str, int]:
    """Violating rows by check, as counted while the feeds were landed."""
    return {check: n for feed in landed.values() for check, n in feed.counted.items()}


def lay_out_feeds(
    landed: dict[str, Landed], staged: dict[str, DataFrame], work: str
) -> dict[str, dict[str, Keyed]]:
    """The staged tables in buckets of the keys they meet on, by key and feed.

    Every table is shuffled once for each of its keys, here. The joins of the lifecycles,
    the unique checks and the coverage invariant then find their rows in place.
    """
    contracts, claims = staged["stg_contracts"], staged["stg_claims"]
    sales, payments = staged["stg_merchant_sales"], staged["stg_servicer_reimbursements"]
    terms = contracts.select("contract_id", "merchant_id", "issued_date", "coverage_limit")
    groups = {
        "sale_id": {"contracts": contracts, "merchant_sales": sales.drop("remittance_date_raw", "customer_email")},
        "contract_id": {"contracts": terms, "claims": claims.drop("status")},
        "claim_id": {"servicer_reimbursements": payments.drop("servicer_id")},
    }

    # One group at a time: the shuffles of one are gone before the next is made.
    return {key: _lay_out(landed, key, tables, work) for key, tables in groups.items()}


def _lay_out(landed: dict[str, Landed], key: str, tables: dict[str, DataFrame], work: str) -> dict[str, Keyed]:
    """Tables in buckets of ``key``, as many for all that meet on it."""
    feeds = [feed for feed, keys in _JOIN_KEYS.items() if key in keys]
    found = [(landed[feed].count, landed[feed].frequent[key]) for feed in feeds]
    size = sum(landed[feed].size for feed in feeds)
    keyed = {name: (df, key) for name, df in tables.items()}
    return lay_out(keyed, size, partial(hot_keys, found), f"{work}/by_{key}")


def lifecycle_views(
    landed: dict[str, Landed], laid: dict[str, dict[str, Keyed]], work: str
) -> dict[str, DataFrame]:
    """Both lifecycles over tables laid out by key, without a shuffle in either. Claims with
    their contract are laid out by claim for that, the one further table; the contract's key
    is the claim's own where there is one, so it is not written twice."""
    by_sale, by_contract, by_claim = (laid[key] for key in ("sale_id", "contract_id", "claim_id"))
    filed = by_parts(claims_with_contract, by_contract["claims"], by_contract["contracts"])
    by_claim = by_claim | _lay_out(landed, "claim_id", {"filed": filed.drop("matched_contract_id")}, work)
    return {
        "int_contract_lifecycle": by_parts(contract_lifecycle, by_sale["contracts"], by_sale["merchant_sales"]),
        "int_claim_lifecycle": by_parts(
            lambda filed, paid: claims_with_few_payments(_matched(filed), paid),
            by_claim["filed"], by_claim["servicer_reimbursements"],
            hot_plan=lambda filed, paid: claims_with_payments(_matched(filed), paid),
        ),
    }


def _matched(filed: DataFrame) -> DataFrame:
    return filed.selectExpr("*", "if(is_orphan_claim, null, claim_contract_id) as matched_contract_id")


def _unique_parts(laid: dict[str, dict[str, Keyed]]) -> dict[str, list[DataFrame]]:
    """Where a unique check finds equal keys together: the layout of a feed by its own key."""
    return {
        table: [part.select(key) for part in (keyed.even, keyed.hot) if part is not None]
        for key, tables in laid.items()
        for feed, keyed in tables.items()
        for table in (feed, f"stg_{feed}")
        if quality.UNIQUE[table] == key
    }


def run_pipeline(
    raw: dict[str, DataFrame],
    output: str,
    as_of: date,
    snapshot_date: date | None = None,
    sla_days: int = SLA_DAYS,
    high_after_days: int = HIGH_AFTER_DAYS,
    full_refresh: bool = False,
    gate: bool = True,
    truth: DataFrame | None = None,
) -> PipelineRun:
    """Land, stage, check, lay out, detect, check, publish, report.

    Tables go below ``output``: ``fct_recon_breaks``, ``fct_daily_break_snapshot``,
    ``break_aging``, ``merchant_scorecard``, each published at once; read them with
    ``read_fact``, ``read_snapshot`` and ``read_table``. The feeds are landed once, so text
    is parsed once, below ``work/<run>``, which also holds the other intermediate tables of
    this run and of no other; :meth:`PipelineRun.close` removes it.

    With ``gate`` a failing check raises :class:`QualityError`: the checks of feeds and
    staged tables before anything is built of them, the coverage invariant and the checks of
    the fact before anything is published. Given a truth log, a type detected less often
    than planted fails the run as well. Without ``gate`` failures are only counted.

    The session's settings are as before when it returns.
    """
    start = time.monotonic()
    spark = raw["contracts"].sparkSession
    work = f"{output}/work/{uuid.uuid4().hex}"
    run = PipelineRun({}, False, work=work)
    pending: Version | None = None
    with tuned(spark, RUNTIME_CONF), freed(spark):
        try:
            landed = land_feeds(raw, f"{work}/feeds")
            with tuned(spark, sized(spark, sum(feed.size for feed in landed.values()) * UNFOLDED)):
                raw = {name: feed.rows for name, feed in landed.items()}
                staged = stage_all(raw)
                laid = lay_out_feeds(landed, staged, work)
                checks = quality.run_checks(
                    raw | staged, counted=feed_counts(landed), parts=_unique_parts(laid)
                )
                _check(run, checks, gate)

                lifecycle = lifecycle_views(landed, laid, work)
                terms = contract_terms(laid["contract_id"]["contracts"].rows())
                _drop(spark, work, "by_contract_id/claims")  # with their contract they lie by claim now
                (built,) = _numbered(
                    lifecycle_marks(lifecycle["int_claim_lifecycle"]), lifecycle["int_contract_lifecycle"], terms,
                    [as_of], sla_days, high_after_days, work,
                )
                pending, counted = stage_counted(built, f"{output}/fct_recon_breaks", snapshot_date or as_of)
                _drop(spark, work, "claim_breaks", "unordered", "ordered")
                fact = pending.read()
                rollup = write_through(reports.break_rollup(fact), "rollup", f"{work}/rollup")
                day = {"fct_recon_breaks": fact, "fct_daily_break_snapshot": fact}
                over = quality.over_coverage(lifecycle["int_claim_lifecycle"])
                _check(run, quality.run_checks(day, counted=counted, over_coverage=over), gate)
                if truth is not None:
                    _check_truth(run, rollup, truth, gate)

                pending.publish()
                pending, fact = None, read_fact(spark, f"{output}/fct_recon_breaks")
                history = f"{output}/fct_daily_break_snapshot"
                scorecard = reports.merchant_scorecard(rollup, raw["merchants"], staged["stg_contracts"])
                run.snapshot_written, aging, scorecard = together(
                    spark,
                    lambda: snapshot_breaks(fact, history, snapshot_date, full_refresh),
                    lambda: publish_table(reports.break_aging(rollup), f"{output}/break_aging"),
                    lambda: publish_table(scorecard, f"{output}/merchant_scorecard"),
                )
        except BaseException:
            run.close(spark)
            if pending is not None:
                pending.discard()
            raise
        marts = {
            "fct_recon_breaks": fact,
            "fct_daily_break_snapshot": read_snapshot(spark, history),
            "break_aging": aging,
            "merchant_scorecard": scorecard,
        }
    run.tables = raw | staged | lifecycle | marts
    run.seconds = time.monotonic() - start
    return run


def _drop(spark: SparkSession, work: str, *tables: str) -> None:
    """Remove tables of a run that nothing reads any more."""
    for table in tables:
        drop_folder(spark, f"{work}/{table}")


def stage_counted(fact: DataFrame, path: str, day: date) -> tuple[Version, dict[str, int]]:
    """Write a version of the fact and count on the way what violates its checks and those
    of the day that will enter the history: the same rows under one date."""
    counts = quality.counted_while_writing("fct_recon_breaks")
    counts |= quality.counted_while_writing(
        "fct_daily_break_snapshot", {"snapshot_date": f"date'{day.isoformat()}'"}
    )
    watch = Observation()
    watched = [F.expr(f"count_if({condition})").alias(check) for check, condition in counts.items()]
    version = stage_fact(fact.observe(watch, *watched), path)
    seen = watch.get
    return version, {check: seen.get(check, 0) for check in counts}


def _check_truth(run: PipelineRun, rollup: DataFrame, truth: DataFrame, gate: bool) -> None:
    run.regressions = reports.truth_regressions(rollup, truth).collect()  # a row a type
    if gate and run.regressions:
        lost = ", ".join(f"{r.break_type} ({r.detected} of {r.planted})" for r in run.regressions)
        raise quality.QualityError(f"planted breaks were not detected: {lost}")


def _check(run: PipelineRun, results: DataFrame, gate: bool) -> None:
    found = quality.assert_quality(results) if gate else _statuses(results)
    for status, n in found.items():
        run.checks[status] = run.checks.get(status, 0) + n


def _statuses(results: DataFrame) -> dict[str, int]:
    return {r["status"]: r["checks"] for r in quality.dq_summary(results).collect()}


def pipeline_summary(run: PipelineRun) -> DataFrame:
    """Rows of every table of a run, and its checks by status."""
    counts = [
        df.select(F.lit(name).alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias("value"))
        for name, df in run.tables.items()
    ]
    spark = next(iter(run.tables.values())).sparkSession
    checks = spark.createDataFrame(
        [(f"checks_{status}", run.checks.get(status, 0)) for status in ("pass", "fail")], "name string, value long"
    )
    return reduce(DataFrame.unionByName, [*counts, checks])
