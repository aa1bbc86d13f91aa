from datetime import date
from decimal import Decimal

import pytest

from tripartite.functions import (
    aging_bucket,
    day,
    days_between,
    describe,
    holds,
    parse_date,
    percent_text,
    ratio,
    severity_rank,
    strict_date,
)

from conftest import AS_OF


def value(spark, expression):
    return spark.range(1).selectExpr(f"{expression} as v").first()["v"]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2025-01-05", "2025-01-05"),
        ("2025-1-5", "2025-01-05"),
        ("2025/01/05", "2025-01-05"),
        (" 2025-01-05 ", "2025-01-05"),
        ("2025-01-05 10:00:00", "2025-01-05"),
        ("2025", None),
        ("2025-01", None),
        ("2025-13-01", None),
        ("2025-02-30", None),
        ("2025-01-05 junk", None),
        ("bad", None),
        ("", None),
    ],
)
def test_parse_date_takes_full_days_only(spark, text, expected):
    found = value(spark, parse_date(f"'{text}'"))
    assert (found.isoformat() if found else None) == expected


@pytest.mark.parametrize(
    ("days", "bucket"),
    [(-3, "0-7 days"), (7, "0-7 days"), (8, "8-30 days"), (30, "8-30 days"),
     (31, "31-60 days"), (60, "31-60 days"), (61, "60+ days")],
)
def test_aging_bucket_edges(spark, days, bucket):
    assert value(spark, aging_bucket(str(days))) == bucket


def test_days_between_counts_forward(spark):
    assert value(spark, days_between("date'2025-06-01'", day(AS_OF))) == 30
    assert value(spark, days_between("date'2025-07-04'", day(AS_OF))) == -3


def test_percent_rounds_half_to_even_and_guards_zero(spark):
    assert value(spark, percent_text("14", "8")) == "175%"
    assert value(spark, percent_text("1", "8")) == "12%"
    assert value(spark, percent_text("3", "8")) == "38%"
    assert value(spark, percent_text("3", "0")) == "N/A"


def test_ratio(spark):
    assert value(spark, ratio("2", "3", 3)) == 0.667
    assert value(spark, ratio("2", "0", 3)) == 0.0


def test_describe_is_null_when_a_value_is(spark):
    amount = "cast(12.5 as decimal(12,2))"
    assert value(spark, describe("Paid {} for {}.", amount, "3")) == "Paid 12.50 for 3."
    assert value(spark, describe("Paid {}", "cast(null as decimal(12,2))")) is None
    assert value(spark, describe("It's fixed.")) == "It's fixed."


def test_holds_and_rank(spark):
    assert value(spark, holds("null > 1")) is False
    assert [value(spark, severity_rank(f"'{s}'")) for s in ("high", "medium", "low")] == [1, 2, 3]


def test_money_cast_rounds_long_fractions(spark):
    assert value(spark, "cast('1244.4524999999999' as decimal(12,2))") == Decimal("1244.45")
    assert value(spark, "cast('537.757' as decimal(12,2))") == Decimal("537.76")


def test_dates_read_as_duckdb_reads_full_days(spark):
    given = [
        "2025-01-05", "2025-1-5", "2025/01/05", "2025 01 05", "2025\\01\\05", "2025 1-5", "2025\\1/5",
        "2025-01-05 10:00", "2025-01-05T10:00:00", "2025-01-05 10:00:00+02", "2025-01-05 10:00:00Z",
        " 2025-01-05 ", "2025-01-05 x", "2025.01.05", "2025-13-01", "bad", "", "2025", "2025-01",
    ]
    import duckdb

    con = duckdb.connect()
    wanted = [con.execute("select try_cast(? as date)", [g]).fetchall()[0][0] for g in given]
    df = spark.createDataFrame([(i, g) for i, g in enumerate(given)], "i int, given string")
    found = [r.d for r in df.selectExpr("i", f"{parse_date('given')} as d").orderBy("i").collect()]
    assert found == wanted


def test_clean_date_columns_refuse_what_is_no_day(spark):
    df = spark.createDataFrame([("2025-01-05",), (None,)], "given string")
    assert [r[0] for r in df.selectExpr(strict_date("given")).collect()] == [date(2025, 1, 5), None]
    for bad in ("2025", "2025-01", "bad"):
        with pytest.raises(Exception, match="not a calendar day"):
            spark.createDataFrame([(bad,)], "given string").selectExpr(strict_date("given")).collect()
