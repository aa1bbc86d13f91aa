"""Every registered query against its DuckDB oracle."""

import re

import duckdb
import pytest

import __spark_entry__ as driver
from conftest import SF_DIR

TABLES = ["nation", "customer", "supplier", "orders", "lineitem"]
SPARK_TO_DUCK = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "date": "DATE", "boolean": "BOOLEAN",
}


# The queries on text corpora have tests of their own.
QUERIES = [q for q in driver.queries() if q != "pipeline" and not re.match(r"op\d+_", q)]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_oracle(spark, duck, name):
    df = driver.queries()[name](spark, SF_DIR)
    answer = duck.execute(driver.oracle_sql()[name])
    columns = [c[0] for c in answer.description]
    kinds = {c[0]: str(c[1]).replace(" ", "") for c in answer.description}
    expected = answer.fetchall()
    assert sorted(df.columns) == sorted(columns)
    assert {c: SPARK_TO_DUCK.get(t, t.upper()) for c, t in df.dtypes} == kinds
    found = [tuple(r) for r in df.select(*columns).collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)


def test_entry(spark):
    fact = driver.entry(spark)
    assert fact.count() == 3312
