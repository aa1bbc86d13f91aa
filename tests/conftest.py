import os
import sys
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tripartite import tune  # noqa: E402
from tripartite.schemas import STAGED_TYPES  # noqa: E402

AS_OF = date(2025, 7, 1)
SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tripartite-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


class conf:
    """Session settings for the length of a with block."""

    def __init__(self, spark, settings):
        self.spark, self.settings = spark, settings

    def __enter__(self):
        self.before = {k: self.spark.conf.get(k, None) for k in self.settings}
        for key, value in self.settings.items():
            self.spark.conf.set(key, value)

    def __exit__(self, *_):
        for key, value in self.before.items():
            if value is None:
                self.spark.conf.unset(key)
            else:
                self.spark.conf.set(key, value)


def d(text):
    return date.fromisoformat(text) if text else None


def m(text):
    return None if text is None else Decimal(text)


def _frame(spark, feed, rows):
    types = STAGED_TYPES[feed]
    names = [c for c in types if c not in ("customer_email", "term_months", "status")]
    schema = ", ".join(f"{c} {types[c]}" for c in names)
    return spark.createDataFrame([dict(zip(names, r, strict=True)) for r in rows], schema)


def contracts(spark, *rows):
    """(contract_id, sale_id, merchant_id, issued, premium, limit)"""
    typed = [(*r[:3], d(r[3]), m(r[4]), m(r[5])) for r in rows]
    return _frame(spark, "contracts", typed).selectExpr("*", "12 as term_months", "'active' as status")


def sales(spark, *rows):
    """(sale_id, merchant_id, sold, premium, remitted, remitted on)"""
    typed = [(*r[:2], d(r[2]), m("100.00"), m(r[3]), m(r[4]), d(r[5])) for r in rows]
    return _frame(spark, "merchant_sales", typed)


def claims(spark, *rows):
    """(claim_id, contract_id, servicer_id, filed, amount)"""
    typed = [(*r[:3], d(r[3]), m(r[4])) for r in rows]
    return _frame(spark, "claims", typed).selectExpr("*", "'approved' as status")


def payments(spark, *rows):
    """(reimbursement_id, claim_id, servicer_id, paid on, amount)"""
    return _frame(
        spark, "servicer_reimbursements", [(*r[:3], d(r[3]), m(r[4])) for r in rows]
    )


def rows(df, *columns):
    """Sorted tuples of the given columns, or of all."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
