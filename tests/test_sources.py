import pytest

from tripartite import sources
from tripartite.schemas import RAW_SCHEMAS, STAGED_TYPES
from tripartite.sources import scratch

import feeds
from conftest import rows


def test_csv_feeds_are_text_and_empty_is_null(spark, tmp_path):
    raw = sources.read_raw_sources(spark, feeds.write(tmp_path))
    assert set(raw) == set(RAW_SCHEMAS)
    for name, df in raw.items():
        assert df.dtypes == [(c, "string") for c in STAGED_TYPES[name]]
        assert df.count() == len(feeds.build()[name])
    assert raw["merchant_sales"].where("remittance_date is null").count() == 2


def test_csv_with_other_columns_is_refused(spark, tmp_path):
    path = tmp_path / "claims.csv"
    path.write_text("claim_id,other\nK1,x\n")
    with pytest.raises(Exception, match="Number of column in CSV header"):
        sources.read_raw_csv(spark, str(path), "claims").collect()


def test_truth_array_with_differing_keys(spark, tmp_path):
    path = tmp_path / "planted.json"
    path.write_text(
        '[\n {"break_type": "amount_break", "sale_id": "S1", "detail": "a"},\n'
        ' {"break_type": "orphan_claim", "claim_id": "K1", "detail": "b"}\n]\n'
    )
    truth = sources.read_truth(spark, str(path), array=True)
    assert rows(truth, "break_type", "sale_id", "contract_id", "claim_id") == [
        ("amount_break", "S1", None, None),
        ("orphan_claim", None, None, "K1"),
    ]
    lines = str(tmp_path / "lines")
    sources.write_json(truth, lines)
    assert rows(sources.read_truth(spark, lines)) == rows(truth)


def test_csv_sink_has_a_header(spark, tmp_path):
    raw = sources.read_raw_sources(spark, feeds.write(tmp_path))["claims"]
    out = str(tmp_path / "out")
    sources.write_csv(raw, out)
    assert rows(sources.read_raw_csv(spark, out, "claims")) == rows(raw)


def test_views_answer_sql(spark, tmp_path):
    sources.register_views(sources.read_raw_sources(spark, feeds.write(tmp_path)), "raw_")
    found = spark.sql("select count(*) as n from raw_claims where status = 'approved'")
    assert found.first()["n"] == 10


def test_written_tables_cut_lineage(spark, tmp_path):
    df = spark.range(10).selectExpr("id", "id * 2 as twice")
    written = sources.write_through(df, "numbers")
    assert rows(written) == rows(df)
    assert "Range" not in written._jdf.queryExecution().executedPlan().toString()
    assert scratch.scratch_path(spark, "a") != scratch.scratch_path(spark, "a")


class _Session:
    """A session as far as :func:`shared_dir` looks at one."""

    def __init__(self, **settings):
        self.conf = settings


def test_shared_folder_is_the_one_the_session_names():
    named = _Session(**{"spark.checkpoint.dir": "hdfs://x/shared/", "spark.master": "yarn"})
    assert scratch.shared_dir(named) == "hdfs://x/shared"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.shared_dir(_Session(**{"spark.master": "yarn"}))
    assert scratch.shared_dir(_Session(**{"spark.master": "local[2]"})).startswith("/")


def test_csv_keeps_quotes_commas_padding_and_line_breaks(spark, tmp_path):
    values = [("M1", 'A "q", b', " padded "), ("M2", "back\\slash", '"'), ("M3", "two\nlines", "x")]
    df = spark.createDataFrame(values, "merchant_id string, merchant_name string, category string")
    out = str(tmp_path / "out")
    sources.write_csv(df, out)
    assert rows(sources.read_raw_csv(spark, out, "merchants", line_breaks=True)) == sorted(values, key=repr)
    path = tmp_path / "merchants.csv"
    path.write_text('merchant_id,merchant_name,category\nM2,"A ""q"", b",y\n')
    assert rows(sources.read_raw_csv(spark, str(path), "merchants")) == [("M2", 'A "q", b', "y")]


@pytest.mark.parametrize("array,text", [(True, '[{"break_type": "a"'), (False, '{"break_type": "a"}\n{"break')])
def test_broken_truth_log_is_an_error(spark, tmp_path, array, text):
    path = tmp_path / "planted.json"
    path.write_text(text)
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        sources.read_truth(spark, str(path), array=array).collect()


def test_dropped_folder(spark, tmp_path):
    sources.write_through(spark.range(3).toDF("id"), "x", str(tmp_path / "x"))
    sources.drop_folder(spark, str(tmp_path / "x"))
    assert not (tmp_path / "x").exists()
