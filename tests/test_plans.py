"""What the physical plans look like, and that hot keys are split without changing results."""

import os
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tripartite import operators as op
from tripartite import plans
from tripartite.schemas import BREAK_TYPES
from tripartite.session import tune
from tripartite.sources import layout, tpch
from tripartite.sources.scratch import source_bytes

import __spark_entry__ as driver
from conftest import SF_DIR, conf, rows

# Thresholds scaled down to the size of the test data.
SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    "spark.sql.shuffle.partitions": "8",
}
N = 12000


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan_of(df).split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def staged(spark):
    return op.stage_all(tpch.raw_sources(spark, SF_DIR))


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the contracts name one sale, of the claims one contract, of the
    payments one claim."""
    money = "cast({} as decimal(12,2))"
    contracts = spark.range(N).selectExpr(
        "concat('C', id) as contract_id", "concat('S', if(id % 3 = 0, 7, id)) as sale_id",
        "concat('M', id % 5) as merchant_id", "date'2025-01-01' as issued_date",
        f"{money.format('10')} as premium", f"{money.format('50 + id % 50')} as coverage_limit",
        "12 as term_months", "'active' as status",
    )
    sales = spark.range(N).where("id % 11 <> 0").selectExpr(
        "concat('S', id) as sale_id", "concat('M', id % 5) as merchant_id",
        "date'2025-01-01' as sale_date", f"{money.format('10')} as product_price",
        f"{money.format('10')} as premium_charged",
        f"{money.format('10 - id % 2')} as remittance_amount",
        "date'2025-01-02' as remittance_date",
    )
    claims = spark.range(N).selectExpr(
        "concat('K', id) as claim_id",
        f"concat('C', if(id % 3 = 0, 5, id + {N // 10})) as contract_id",
        "concat('V', id % 7) as servicer_id", "date'2025-02-01' as claim_date",
        f"{money.format('10 + id % 9')} as claim_amount", "'approved' as status",
    )
    payments = spark.range(N).selectExpr(
        "concat('R', id) as reimbursement_id",
        "concat('K', if(id % 3 = 0, 9, id * 2)) as claim_id",
        "concat('V', id % 7) as servicer_id", "date'2025-03-01' as paid_date",
        f"{money.format('5 + pmod(hash(id), 2000) / 100')} as paid_amount",
    )
    return {
        "stg_contracts": contracts.repartition(8),
        "stg_merchant_sales": sales.repartition(8),
        "stg_claims": claims.repartition(8),
        "stg_servicer_reimbursements": payments.repartition(8),
    }


def test_hot_keys_are_split(spark, hot):
    with conf(spark, SMALL):
        both = plans.lifecycles(hot)
        contract, claim = both["int_contract_lifecycle"], both["int_claim_lifecycle"]
        # Contracts on a hot sale: the left side of a left join is split.
        assert re.search(r"skew=true\) \[contract_sale_id.*LeftOuter", final_plan(contract))
        # Claims on a hot contract, then payments on a hot claim: split on either side.
        for df in (claim, op.detect_overpayment(claim)):
            plan = final_plan(df)
            assert re.search(r"skew=true\) \[claim_contract_id.*LeftOuter", plan)
            assert re.search(r"skew=true\) \[coalesce\(claim_id.*Inner", plan)
        # An aggregate on the join key does not keep the hot key together.
        for df in (op.detect_duplicate_claim(claim), op.contract_payouts(claim)):
            assert re.search(r"skew=true\) \[coalesce\(claim_id.*Inner", final_plan(df))
        checked = plans.reimbursement_within_coverage(
            hot["stg_servicer_reimbursements"], hot["stg_claims"], hot["stg_contracts"]
        )
        assert "skew=true" in final_plan(checked)


def test_results_under_hot_keys_match_brute_force(spark, hot):
    with conf(spark, SMALL):
        both = plans.lifecycles(hot)
        found = op.all_breaks(both["int_contract_lifecycle"], both["int_claim_lifecycle"], tpch.AS_OF).collect()
        lazy = plans.build_breaks(hot, tpch.AS_OF).collect()
        rows = {name: df.collect() for name, df in hot.items()}
    contracts = {r["contract_id"]: r for r in rows["stg_contracts"]}
    sales = {r["sale_id"]: r for r in rows["stg_merchant_sales"]}
    claims = {r["claim_id"]: r for r in rows["stg_claims"]}
    by_claim, by_contract = defaultdict(list), Counter()
    expected = Counter()
    for r in rows["stg_servicer_reimbursements"]:
        claim = claims.get(r["claim_id"])
        if claim is None:
            continue
        by_claim[claim["claim_id"]].append(r["paid_amount"])
        by_contract[claim["contract_id"]] += r["paid_amount"]
        excess = r["paid_amount"] - claim["claim_amount"]
        if excess * 100 > 1:
            expected["overpayment", r["reimbursement_id"], excess] += 1
    for c in contracts.values():
        sale = sales.get(c["sale_id"])
        if sale is None:
            expected["orphan_contract", c["contract_id"], c["premium"]] += 1
        elif abs(sale["remittance_amount"] - c["premium"]) * 100 > 1:
            off = abs(sale["remittance_amount"] - c["premium"])
            expected["amount_break", c["contract_id"], off] += 1
        over = by_contract[c["contract_id"]] - c["coverage_limit"]
        if over > 0:
            expected["coverage_exceeded", c["contract_id"], over] += 1
    for claim in claims.values():
        if claim["contract_id"] not in contracts:
            expected["orphan_claim", claim["claim_id"], claim["claim_amount"]] += 1
        paid = by_claim[claim["claim_id"]]
        if len(paid) > 1:
            expected["duplicate_claim", claim["claim_id"], sum(paid) - claim["claim_amount"]] += 1
    assert Counter((r["break_type"], r["entity_id"], r["amount_at_risk"]) for r in found) == expected
    assert Counter((r["break_type"], r["entity_id"], r["amount_at_risk"]) for r in lazy) == expected
    # All sales are paid, so there are no timing breaks.
    assert {k[0] for k in expected} == set(BREAK_TYPES) - {"timing_break"}


def test_claims_meet_contracts_once_for_paid_and_unpaid(spark, staged, tmp_path):
    """Columns read from files may be null, which must not make the two joins differ."""
    read = {}
    for name, df in staged.items():
        df.write.parquet(f"{tmp_path}/{name}")
        read[name] = spark.read.parquet(f"{tmp_path}/{name}")
    with conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        plan = final_plan(plans.lifecycles(read)["int_claim_lifecycle"])
    assert plan.count("LeftOuter") == 1
    assert plan.count("ReusedExchange") == 1


def test_detectors_drop_what_they_do_not_need(spark, staged):
    both = plans.lifecycles(staged)
    orphan = plan_of(
        op.detect_orphan_claim(
            op.claims_with_contract(staged["stg_claims"], staged["stg_contracts"])
        )
    )
    assert orphan.count("lineitem.parquet") == 1  # claims, not payments
    # Detectors of paid claims prune the branch of unpaid ones.
    for df in (
        op.detect_overpayment(both["int_claim_lifecycle"]),
        op.detect_duplicate_claim(both["int_claim_lifecycle"]),
        op.contract_payouts(both["int_claim_lifecycle"]),
    ):
        assert "LeftAnti" not in plan_of(df)


@pytest.mark.parametrize(
    ("name", "joins"),
    [("detect_duplicate_claim", 1), ("detect_overpayment", 1), ("contract_payouts", 1), ("detect_coverage_exceeded", 2)],
)
def test_rules_on_payments_join_what_they_use(spark, tmp_path, staged, name, joins):
    read = {}
    for feed, df in staged.items():
        df.write.parquet(f"{tmp_path}/{feed}")
        read[feed] = spark.read.parquet(f"{tmp_path}/{feed}")
    with conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        paid = op.paid_claims(read["stg_claims"], read["stg_servicer_reimbursements"])
        detect = getattr(op, name)
        if name == "detect_coverage_exceeded":
            df = detect(op.contract_terms(read["stg_contracts"]), paid)
        else:
            df = detect(paid)
        assert len(re.findall(r"(?:SortMerge|Hash)Join", plan_of(df))) == joins


def test_claims_that_lie_by_claim_travel_once_more(spark, tmp_path, staged):
    """Two shuffles meet payments and claims, two what they found and the terms."""
    read = {}
    for feed, df in staged.items():
        df.write.parquet(f"{tmp_path}/{feed}")
        read[feed] = spark.read.parquet(f"{tmp_path}/{feed}")
    with conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        paid = op.paid_claims(read["stg_claims"], read["stg_servicer_reimbursements"])
        found = op.claim_breaks(paid, op.contract_terms(read["stg_contracts"]), dealt=True)
        assert plan_of(found).count("Exchange hashpartitioning") == 4


def test_facts_of_several_days_find_the_breaks_of_claims_once(spark, tmp_path, staged, monkeypatch):
    days = [driver.DAY_BEFORE, driver.AS_OF]
    written = []
    real = plans.pipeline.write_through
    monkeypatch.setattr(plans.pipeline, "write_through", lambda df, name: written.append(name) or real(df, name))
    facts = plans.build_facts(staged, days)
    assert written == ["claim_breaks"]
    for day, fact in zip(days, facts, strict=True):
        assert rows(fact) == rows(plans.build_fact(staged, day))


def test_contract_detail_does_not_shuffle_all_sales(spark, tmp_path, staged):
    for feed in ("stg_contracts", "stg_merchant_sales"):
        staged[feed].write.parquet(f"{tmp_path}/{feed}")
    contracts, sales = (spark.read.parquet(f"{tmp_path}/{f}") for f in ("stg_contracts", "stg_merchant_sales"))
    with conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        plan = plan_of(plans.contract_detail(contracts, sales, "742"))
    # The sales meet the one sale id where they are read.
    assert re.search(r"BroadcastHashJoin [^\n]*LeftSemi", plan)


def test_lookup_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "staged")
    op.stage_all(tpch.raw_sources(spark, SF_DIR, ["claims"]))["stg_claims"].write.parquet(path)
    found = plans.servicer_claims(spark.read.parquet(path).drop("claim_date"), "S3")
    plan = plan_of(found)
    assert "EqualTo(servicer_id,S3)" in plan and "EqualTo(status,approved)" in plan
    assert "claim_date" not in plan


def test_breaks_are_pruned_by_column(spark, tmp_path, staged):
    """A count of breaks reads no wording, no money but what decides, and no orphan claims
    where another type is asked for."""
    for name in staged:
        staged[name].write.parquet(f"{tmp_path}/{name}")
    held = {name: spark.read.parquet(f"{tmp_path}/{name}") for name in staged}
    plan = plan_of(plans.detected_counts(plans.build_breaks(held, tpch.AS_OF).where("break_type = 'orphan_contract'")))
    scans = re.findall(r"ReadSchema: (\S+)", plan)
    assert not any("term_months" in s or "product_price" in s or "customer_email" in s for s in scans)
    assert plan.count("FileScan") == 5  # contracts and sales; claims, payments and terms


UNNUMBERED = [
    "stg_merchant_sales", "stg_claims", "int_contract_lifecycle", "int_claim_lifecycle",
    "detect_orphan_contract", "detect_timing_break", "detect_amount_break",
    "detect_orphan_claim", "detect_duplicate_claim", "detect_overpayment",
    "detect_coverage_exceeded", "contract_payouts", "all_breaks", "days_open",
    "merchant_totals", "merchant_breaks", "merchant_scorecard",
    "truth_validation", "dq_unique", "dq_relationships", "dq_singular_coverage",
]


@pytest.mark.parametrize("name", UNNUMBERED)
def test_no_query_gathers_rows_or_leaves_the_jvm(spark, name):
    plan = plan_of(driver.queries()[name](spark, SF_DIR))
    assert "SinglePartition" not in plan
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("name", ["fct_recon_breaks", "break_drilldown", "break_report"])
def test_only_partition_counts_meet_in_one_task(spark, name):
    """Numbering adds up the row counts of the sort's partitions in one task."""
    plan = plan_of(driver.queries()[name](spark, SF_DIR))
    single = plan[plan.index("SinglePartition"):]
    # What goes into the single task is an aggregate already: one row per partition.
    assert re.match(r"SinglePartition[^\n]*\n *\+- (\*\(\d+\) )?HashAggregate", single)
    assert plan.count("SinglePartition") == 1


def test_shuffle_width_follows_the_input(spark):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    with conf(spark, {key: "4"}):
        tune(spark, input_bytes=1 << 40)
        assert int(spark.conf.get(key)) == 4096
        tune(spark, input_bytes=100 << 40)
        assert int(spark.conf.get(key)) == 32768
        tune(spark, input_bytes=1)
        assert int(spark.conf.get(key)) == spark.sparkContext.defaultParallelism


def test_size_is_that_of_the_files_not_of_the_join(spark, tmp_path):
    """Feeds with a join inside count the files they read, once each."""
    raw = tpch.raw_sources(spark, SF_DIR)
    read = ["nation", "supplier", "orders", "customer", "lineitem"]
    assert source_bytes(*raw.values()) == sum(os.path.getsize(f"{SF_DIR}/{t}.parquet") for t in read)
    landed = plans.land_feeds(raw, str(tmp_path / "feeds"))
    for name, feed in landed.items():
        written = sum(f.stat().st_size for f in (tmp_path / "feeds" / name).glob("part-*"))
        assert written <= feed.size <= written * 1.1 + 1000  # checksums beside the parts
        assert feed.count == raw[name].count()


def test_one_read_of_the_lifecycles(spark, tmp_path, staged):
    both = {}
    for name, df in plans.lifecycles(staged).items():
        df.write.parquet(f"{tmp_path}/{name}")
        both[name] = spark.read.parquet(f"{tmp_path}/{name}")
    found = op.all_breaks(both["int_contract_lifecycle"], both["int_claim_lifecycle"], tpch.AS_OF)
    plan = plan_of(found)
    assert plan.count("FileScan parquet") == 3
    assert len(re.findall(r"ReadSchema: struct<[^>]*reimbursement_id", plan)) == 1


# ---- layouts by key --------------------------------------------------------------------


def laid_out(spark, feeds_by_name, folder):
    raw = {f.removeprefix("stg_"): df for f, df in feeds_by_name.items()}
    for name, columns in (("merchants", "merchant_id, 'x' merchant_name, 'y' category"), ("servicers", "merchant_id servicer_id, 'x' servicer_name")):
        raw.setdefault(name, raw["merchant_sales"].selectExpr(*columns.split(", ")).distinct())
    # Raw feeds are text.
    raw["merchant_sales"] = raw["merchant_sales"].withColumn("customer_email", F.lit(None).cast("string"))
    raw = {n: df.select(*[F.col(c).cast("string") for c in df.columns]) for n, df in raw.items()}
    landed = plans.land_feeds(raw, f"{folder}/feeds")
    staged = op.stage_all({n: f.rows for n, f in landed.items()})
    laid = plans.lay_out_feeds(landed, staged, str(folder))
    return landed, staged, laid, plans.lifecycle_views(landed, laid, str(folder))


def test_joins_on_laid_out_tables_do_not_shuffle(spark, tmp_path, staged):
    raw = tpch.raw_sources(spark, SF_DIR)
    landed = plans.land_feeds(raw, str(tmp_path / "feeds"))
    typed = op.stage_all({n: f.rows for n, f in landed.items()})
    laid = plans.lay_out_feeds(landed, typed, str(tmp_path))
    with conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        both = plans.lifecycle_views(landed, laid, str(tmp_path))
        for view, joins in (("int_contract_lifecycle", 1), ("int_claim_lifecycle", 1)):
            plan = plan_of(both[view])
            assert plan.count("SortMergeJoin") == joins and "Exchange" not in plan
        over = plan_of(plans.over_coverage(both["int_claim_lifecycle"]))
        assert "Exchange" not in over
        key = laid["contract_id"]["contracts"].even.select("contract_id")
        assert "Exchange" not in plan_of(plans.unique(key, "contract_id"))
    assert rows(both["int_claim_lifecycle"]) == rows(plans.lifecycles(staged)["int_claim_lifecycle"])
    assert rows(both["int_contract_lifecycle"]) == rows(plans.lifecycles(staged)["int_contract_lifecycle"])
    # Nothing stays in the catalog.
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("tripartite_")]


def test_hot_keys_are_kept_apart_and_split(spark, hot, tmp_path, monkeypatch):
    monkeypatch.setattr(layout, "LEAST_HOT", 100)
    with conf(spark, SMALL):
        landed, _, laid, both = laid_out(spark, hot, tmp_path)
        payments = laid["claim_id"]["servicer_reimbursements"]
        assert rows(payments.hot.select("claim_id").distinct()) == [("K9",)]
        assert payments.even.where("claim_id = 'K9'").isEmpty()
        assert payments.rows().count() == N
        sizes = [r["count"] for r in payments.even.groupBy("_metadata.file_name").count().collect()]
        assert max(sizes) < 2 * sum(sizes) / len(sizes)
        claims = laid["contract_id"]["claims"]
        assert rows(claims.hot.select("contract_id").distinct()) == [("C5",)]
        assert rows(laid["sale_id"]["contracts"].hot.select("sale_id").distinct()) == [("S7",)]
        plan = final_plan(both["int_claim_lifecycle"])
        assert re.search(r"skew=true\) \[coalesce\(claim_id.*Inner", plan)
        expected = plans.lifecycles(hot)
        for view in both:
            assert both[view].exceptAll(expected[view].select(*both[view].columns)).isEmpty()
            assert both[view].count() == expected[view].count()
        found = op.all_breaks(
            both["int_contract_lifecycle"], both["int_claim_lifecycle"], tpch.AS_OF,
            terms=op.contract_terms(laid["contract_id"]["contracts"].rows()),
        )
        assert rows(found) == rows(plans.build_breaks(hot, tpch.AS_OF), *found.columns)


def test_many_rows_without_a_key_are_kept_apart(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(layout, "LEAST_HOT", 100)
    df = spark.range(3000).selectExpr("if(id % 3 = 0, null, cast(id as string)) as k", "id")
    found = layout.land({"t": df}, str(tmp_path / "a"), {"t": {"odd": "id % 2 = 1"}}, {"t": ["k"]}, 8)["t"]
    assert (found.count, found.counted, found.frequent["k"][None]) == (3000, {"odd": 1500}, 1000)
    assert layout.hot_keys([(found.count, found.frequent["k"])], 8) == [None]
    kept = layout.lay_out({"t": (found.rows, "k")}, 1, lambda buckets: [None], str(tmp_path / "b"))["t"]
    assert kept.hot.count() == 1000 and kept.even.where("k is null").isEmpty()
    empty = layout.land({"t": df.where("id < 0")}, str(tmp_path / "c"), {"t": {"odd": "id % 2 = 1"}}, {"t": ["k"]}, 8)["t"]
    assert (empty.count, empty.counted) == (0, {"odd": 0})
    assert layout.lay_out({"t": (empty.rows, "k")}, 1, lambda buckets: [], str(tmp_path / "d"))["t"].rows().count() == 0
