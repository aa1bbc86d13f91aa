"""What queries over the breaks put on disk: rows that travel once, and files that go when read."""

import re
import time
from datetime import date

import pytest

from tripartite import operators as op
from tripartite import plans, sources
from tripartite.session import UNFOLDED, freed, together, width
from tripartite.sources import layout, tables, tpch

import feeds
from conftest import AS_OF, SF_DIR, claims, conf, contracts, payments, rows, sales

FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@pytest.fixture(scope="module")
def staged(spark):
    return op.stage_all(tpch.raw_sources(spark, SF_DIR))


@pytest.fixture(scope="module")
def read(spark, staged, tmp_path_factory):
    """The same from files, whose columns may be null."""
    folder = tmp_path_factory.mktemp("staged")
    for name, df in staged.items():
        df.write.parquet(f"{folder}/{name}")
    return {name: spark.read.parquet(f"{folder}/{name}") for name in staged}


def breaks_of(feeds, dealt):
    both = plans.lifecycles(feeds, grouped=bool(dealt))
    return op.all_breaks(both["int_contract_lifecycle"], both["int_claim_lifecycle"], tpch.AS_OF, dealt=dealt)


def shuffles(df):
    """The keys of the shuffles that are made, those that are read again once."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return re.findall(r"^[\s:+\-]*Exchange hashpartitioning\((\S+?)[#,)]", plan, re.MULTILINE)


@pytest.mark.parametrize("source", ["staged", "read"])
def test_claims_travel_once_by_contract_and_once_by_claim(spark, request, source):
    feeds = request.getfixturevalue(source)
    with conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        made = shuffles(breaks_of(feeds, op.BY_CLAIM))
    assert made.count("claim_contract_id") == 1
    # Claims, payments and names of paid claims (these by name first where it may be null).
    by_claim = [key for key in made if re.sub(r"^coalesce\(", "", key) in ("claim_id", "paid_claim_id")]
    assert len(by_claim) <= (3 if source == "staged" else 4)
    # Groups form where the claims lie: none of their columns is a key.
    assert not {"id", "rule", "lies_by_0"} & set(made)


def test_breaks_by_claim_are_those_of_any_rows(spark):
    """Also where keys are repeated or missing."""
    feeds = {
        "stg_contracts": contracts(
            spark, *[("C1", "S1", "M1", "2001-05-01", "20.00", "100.00")] * 2,
            ("C2", None, "M2", "2001-06-25", "30.00", "10.00"), (None, "S1", "M1", None, "9.00", "1.00"),
        ),
        "stg_merchant_sales": sales(spark, *[("S1", "M1", "2001-05-01", "20.00", "19.00", None)] * 2),
        "stg_claims": claims(
            spark, *[("K1", "C1", "V1", "2001-06-16", "80.00")] * 2, ("K1", "C2", "V0", "2001-06-30", "81.00"),
            ("K2", "C404", "V1", "2001-06-17", "80.00"), ("K3", None, "V1", None, None), ("", "C2", "V3", None, "1.00"),
            *[(None, "C404", "V1", "2001-06-17", "5.00")] * 2, (None, "C2", "V2", None, "5.00"),
        ),
        "stg_servicer_reimbursements": payments(
            spark, ("R1", "K1", "V9", "2001-06-16", "60.00"), *[("R2", "K1", "V9", "2001-06-17", "90.00")] * 2,
            ("R3", "K2", "V9", None, "80.02"), ("R4", None, "V9", None, "30.00"), (None, "", "V9", None, "50.00"),
        ),
    }
    found = rows(breaks_of(feeds, op.BY_CLAIM))
    assert found == rows(breaks_of(feeds, False))
    assert {r[0] for r in found} == set(op.detect.DESCRIPTIONS)


def test_hot_claims_are_split_where_groups_form_by_claim(spark):
    money = "cast({} as decimal(12,2))"
    n = 12000
    feeds = {
        "stg_claims": spark.range(n).selectExpr(
            "concat('K', id) as claim_id", "concat('C', id % 50) as contract_id", "'V' as servicer_id",
            "date'2001-02-01' as claim_date", f"{money.format('10 + id % 9')} as claim_amount", "'x' as status",
        ),
        "stg_servicer_reimbursements": spark.range(n).selectExpr(
            "concat('R', id) as reimbursement_id", "concat('K', if(id % 3 = 0, 9, id * 2)) as claim_id",
            "'V' as servicer_id", "date'2001-03-01' as paid_date", f"{money.format('5 + id % 20')} as paid_amount",
        ),
        "stg_contracts": spark.range(60).selectExpr(
            "concat('C', id) as contract_id", "concat('S', id) as sale_id", "'M' as merchant_id",
            "date'2001-01-01' as issued_date", f"{money.format('10')} as premium",
            f"{money.format('900')} as coverage_limit", "12 as term_months", "'active' as status",
        ),
    }
    feeds = {name: df.repartition(8) for name, df in feeds.items()}
    feeds["stg_merchant_sales"] = sales(spark, ("S1", "M", "2001-01-01", "10.00", "9.00", None))
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    }
    with conf(spark, small):
        found = breaks_of(feeds, op.BY_CLAIM)
        plan = (found.collect(), found._jdf.queryExecution().executedPlan().toString())[1]
        assert re.search(r"skew=true\) \[(coalesce\()?claim_id.*Inner", plan.split("== Initial Plan ==")[0])
        assert rows(found) == rows(breaks_of(feeds, False))


# ---- files that go when they have been read ----------------------------------------------


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(i).getName() for i in range(files.size())]
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def gone(spark, before):
    """Whether no shuffle file is there that was not before; they are removed in the background."""
    for _ in range(50):
        if shuffle_files(spark) <= before:
            return True
        time.sleep(0.2)
    return False


def shuffled(spark):
    return spark.range(1000).selectExpr("id % 7 as k").groupBy("k").count()


def test_shuffles_of_what_is_written_go_at_once(spark, tmp_path):
    before = shuffle_files(spark)
    kept = shuffled(spark)
    kept.collect()
    assert shuffle_files(spark) > before  # Spark itself keeps them
    before = shuffle_files(spark)
    written = sources.write_through(shuffled(spark), "t", str(tmp_path / "t"))
    sources.publish_table(shuffled(spark), str(tmp_path / "p"))
    landed = layout.land({"t": shuffled(spark)}, str(tmp_path / "l"), {}, {"t": ["k"]}, 4)
    numbered = op.numbering.number_rows(shuffled(spark), ["k"], "n", str(tmp_path / "n"))
    assert landed["t"].count == 7
    assert gone(spark, before)
    assert rows(numbered, "k", "n") == [(k, k + 1) for k in range(7)]
    assert written.count() == 7


def test_blocks_that_free_may_overlap_and_leave_the_setting(spark):
    for given in (None, "false"):
        with conf(spark, {FREED: "false"}):
            if given is None:
                spark.conf.unset(FREED)

            def block(seconds):
                with freed(spark):
                    time.sleep(seconds)
                    return spark.conf.get(FREED)

            assert together(spark, *[lambda s=s: block(s) for s in (0.1, 0.5, 0.3)]) == ["true"] * 3
            assert spark.conf.get(FREED, None) == given


def test_a_run_keeps_no_table_that_nothing_reads(spark, tmp_path):
    raw = sources.read_raw_sources(spark, feeds.write(tmp_path))
    run = plans.run_pipeline(raw, str(tmp_path / "out"), AS_OF, snapshot_date=AS_OF)
    (work,) = (tmp_path / "out/work").iterdir()
    assert not {"claim_breaks", "unordered", "ordered"} & {p.name for p in work.iterdir()}
    assert {p.name for p in (work / "by_contract_id").iterdir()} == {"contracts"}
    # What is left is all that its tables need.
    assert dict(rows(plans.pipeline_summary(run)))["fct_recon_breaks"] == sum(feeds.EXPECTED.values())
    for table in run.tables.values():
        table.collect()
    assert spark.conf.get(FREED, None) is None


def test_a_run_sorts_marks_not_told_breaks(spark, tmp_path, monkeypatch):
    """And its fact is that of breaks that travel whole."""
    sorted_by = []
    real = op.numbering.number_rows
    monkeypatch.setattr(op.numbering, "number_rows", lambda df, *rest: sorted_by.append(df.columns) or real(df, *rest))
    raw = sources.read_raw_sources(spark, feeds.write(tmp_path))
    run = plans.run_pipeline(raw, str(tmp_path / "out"), AS_OF, snapshot_date=AS_OF)
    assert sorted_by == [["rule", "id", "party", "opened", "held", "total", "payments"]]
    whole = op.with_break_key(plans.build_breaks(op.stage_all(raw), AS_OF))
    assert rows(run.tables["fct_recon_breaks"]) == rows(whole)


def test_rows_without_work_folder_are_not_kept_twice(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(op.numbering, "scratch_path", lambda session, name: str(tmp_path / name))
    numbered = op.numbering.number_rows(shuffled(spark), ["k"], "n")
    assert [p.name for p in tmp_path.iterdir()] == ["ordered"]
    assert numbered.count() == 7


def test_buckets_are_as_many_as_their_rows_ask_for(spark, tmp_path):
    asked, size = [], 1 << 33
    rows_of = {"t": (spark.range(10).selectExpr("cast(id as string) as k"), "k")}

    def hot(buckets):
        asked.append(buckets)
        raise InterruptedError

    with pytest.raises(InterruptedError):
        layout.lay_out(rows_of, size, hot, str(tmp_path))
    assert asked == [width(spark, size * UNFOLDED)] and asked[0] >= 8 * (size >> 28)


# ---- corrections --------------------------------------------------------------------------


@pytest.mark.parametrize("key", [["snapshot_date", "break_key"], ["break_key"]])
def test_only_rows_of_held_days_can_replace(spark, tmp_path, monkeypatch, key):
    def on(*given):
        schema = "snapshot_date date, break_key bigint, description string"
        return spark.createDataFrame([(date.fromisoformat(d) if d else None, k, t) for d, k, t in given], schema)

    path = str(tmp_path / "history")
    first = on(*[("2025-07-01", k, "found") for k in range(4)])
    sources.correct_snapshot(spark, path, first, key)
    asked = []
    real = tables._without
    monkeypatch.setattr(tables, "_without", lambda held, new, by: asked.append(new) or real(held, new, by))
    new = on(("2025-07-01", 1, "again"), ("2025-07-02", 2, "next"), (None, 3, "undated"))
    sources.correct_snapshot(spark, path, new, key)
    by_day = len(key) == 2
    assert rows(asked[0], "break_key") == ([(1,)] if by_day else [(1,), (2,), (3,)])
    left = [(0, "found"), (1, "again"), *([(2, "found"), (2, "next"), (3, "found")] if by_day else [(2, "next")]), (3, "undated")]
    assert rows(sources.read_snapshot(spark, path), "break_key", "description") == left
