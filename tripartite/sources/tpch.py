"""The six feeds derived from order-processing tables.

Merchants are nations, servicers suppliers, contracts and sales come from orders,
claims and payments from line items, whose return flag gives the claim's status. Modulus
rules on the keys leave out or falsify some records; they are what plants the known
breaks of :func:`planted_breaks`. Every row of every table takes part.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = date(2001, 8, 1)

# One order in so many is affected.
NO_SALE = 61
UNPAID = 53
UNDERPAID = 37
NO_CONTRACT = 71
NO_REIMBURSEMENT = 43
UNKNOWN_AMOUNT = 106  # unpaid, and no amount is known
STATUS = {"A": "approved", "N": "pending", "R": "reopened"}


Reader = Callable[[str], DataFrame]


def _reader(spark: SparkSession, root: str) -> Reader:
    """Opens each table once, when a feed first asks for it."""
    return cache(lambda name: spark.read.parquet(f"{root}/{name}.parquet"))


def _share(share: str) -> str:
    return f"cast(round(tp * cast({share} as decimal(3,2)), 2) as decimal(12,2))"


_MERCHANT = "concat('M', lpad(cast({} as string), 3, '0')) as merchant_id"
_CLAIM = "concat_ws('-', l_orderkey, l_linenumber) as claim_id"
_ORDER = "cast(o_orderkey as string)"
# Sales have keys of their own, told apart from the contracts'.
_SALE = f"concat('T', {_ORDER})"


def _orders(table: Reader) -> DataFrame:
    """Orders with the nation of their customer. The customer's side of the join has
    unique keys; a customer with very many orders is split by adaptive execution."""
    customer = table("customer").select("c_custkey", "c_nationkey")
    orders = table("orders").selectExpr(
        "o_orderkey",
        "o_custkey",
        "cast(o_orderdate as date) as day",
        "cast(o_totalprice as decimal(12,2)) as tp",
    )
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))


def merchants(table: Reader) -> DataFrame:
    return table("nation").selectExpr(
        _MERCHANT.format("n_nationkey"),
        "n_name as merchant_name",
        "concat('region-', cast(n_regionkey as string)) as category",
    )


def servicers(table: Reader) -> DataFrame:
    return table("supplier").selectExpr(
        "concat('S', cast(s_suppkey as string)) as servicer_id", "s_name as servicer_name"
    )


def contracts(table: Reader) -> DataFrame:
    return _orders(table).selectExpr(
        f"{_ORDER} as contract_id",
        f"{_SALE} as sale_id",
        _MERCHANT.format("c_nationkey"),
        "cast(day as string) as issued_date",
        f"{_share('0.10')} as premium",
        "tp as coverage_limit",
        "12 * (1 + cast(o_orderkey % 3 as int)) as term_months",
        "'active' as status",
    )


def merchant_sales(table: Reader) -> DataFrame:
    remitted = (
        f"case when o_orderkey % {UNKNOWN_AMOUNT} = 0 then null"
        f" when o_orderkey % {UNPAID} = 0 then cast(0 as decimal(12,2))"
        f" when o_orderkey % {UNDERPAID} = 0 then {_share('0.09')} else {_share('0.10')} end"
    )
    paid_on = f"if(o_orderkey % {UNPAID} = 0, '', cast(date_add(day, 5) as string))"
    return _orders(table).where(f"o_orderkey % {NO_SALE} <> 0").selectExpr(
        f"{_SALE} as sale_id",
        _MERCHANT.format("c_nationkey"),
        "cast(day as string) as sale_date",
        "tp as product_price",
        f"{_share('0.10')} as premium_charged",
        f"{remitted} as remittance_amount",
        f"{paid_on} as remittance_date",
        "concat('cust_', cast(o_custkey as string), '@example.com') as customer_email",
    )


def claims(table: Reader) -> DataFrame:
    lines = table("lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.min(F.ascii("l_returnflag")).alias("flag"),  # one letter; a number is hashed, not sorted
        F.min("l_suppkey").alias("suppkey"),
        F.min("l_shipdate").alias("shipped"),
        F.min("l_extendedprice").alias("price"),
    )
    prefix = f"if(l_orderkey % {NO_CONTRACT} = 0, 'X', '')"
    status = " ".join(f"when {ord(flag)} then '{name}'" for flag, name in STATUS.items())
    return lines.selectExpr(
        _CLAIM,
        f"concat({prefix}, cast(l_orderkey as string)) as contract_id",
        "concat('S', cast(suppkey as string)) as servicer_id",
        "cast(cast(shipped as date) as string) as claim_date",
        "cast(price as decimal(12,2)) as claim_amount",
        f"case flag {status} end as status",
    )


def servicer_reimbursements(table: Reader) -> DataFrame:
    shipped = "cast(l_shipdate as date)"
    return table("lineitem").where(f"l_orderkey % {NO_REIMBURSEMENT} <> 0").selectExpr(
        f"concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, {shipped})"
        " as reimbursement_id",
        _CLAIM,
        "concat('S', cast(l_suppkey as string)) as servicer_id",
        f"cast(date_add({shipped}, 14) as string) as paid_date",
        "cast(l_extendedprice as decimal(12,2)) as paid_amount",
    )


_FEEDS = {
    "merchants": merchants,
    "servicers": servicers,
    "merchant_sales": merchant_sales,
    "contracts": contracts,
    "claims": claims,
    "servicer_reimbursements": servicer_reimbursements,
}


def raw_sources(
    spark: SparkSession, root: str, names: Sequence[str] = tuple(_FEEDS)
) -> dict[str, DataFrame]:
    """The raw feeds (all six, or those named) over the parquet tables in ``root``."""
    table = _reader(spark, root)
    return {name: _FEEDS[name](table) for name in names}


def planted_breaks(spark: SparkSession, root: str) -> DataFrame:
    """The breaks the modulus rules plant, as records of the truth log."""
    table = _reader(spark, root)
    kind = (
        f"case when o_orderkey % {NO_SALE} = 0 then 'orphan_contract'"
        f" when o_orderkey % {UNPAID} = 0 then 'timing_break'"
        f" when o_orderkey % {UNDERPAID} = 0 then 'amount_break' end"
    )
    by_order = (
        _orders(table)
        .selectExpr(f"{kind} as break_type", f"{_ORDER} as id")
        .where("break_type is not null")
        .selectExpr(
            "break_type",
            "if(break_type = 'orphan_contract', null, concat('T', id)) as sale_id",
            "if(break_type = 'orphan_contract', id, null) as contract_id",
            "cast(null as string) as claim_id",
        )
    )
    no_contract = table("lineitem").where(f"l_orderkey % {NO_CONTRACT} = 0")
    by_claim = (
        no_contract.selectExpr(_CLAIM)
        .distinct()
        .selectExpr(
            "'orphan_claim' as break_type",
            "cast(null as string) as sale_id",
            "cast(null as string) as contract_id",
            "claim_id",
        )
    )
    return by_order.unionByName(by_claim).selectExpr(
        "*",
        "cast(null as string) as reimbursement_id",
        "concat('planted ', break_type) as detail",
    )
