"""Typed, one-to-one projections of the raw feeds. Lazy; nothing is stored."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tripartite.functions import parse_date, strict_date
from tripartite.schemas import STAGED_TYPES

STAGED_FEEDS = ["merchant_sales", "contracts", "claims", "servicer_reimbursements"]


def typed(feed: str) -> dict[str, str]:
    """The expression of each staged column over the raw feed; text columns pass as they
    are, dates must be full days, but for the one dirty column."""

    def cast(column: str, kind: str) -> str:
        if kind == "string":
            return column
        if column == "remittance_date":
            return parse_date(_GIVEN)
        return strict_date(column) if kind == "date" else f"cast({column} as {kind})"

    return {column: cast(column, kind) for column, kind in STAGED_TYPES[feed].items()}


_GIVEN = "nullif(remittance_date, '')"


def _selected(feed: str) -> list[str]:
    return [f"{expression} as {column}" for column, expression in typed(feed).items()]


def stage_merchant_sales(raw: DataFrame) -> DataFrame:
    """A null ``remittance_date`` means the merchant has not paid yet.

    It is the one dirty column, so it is parsed, and also kept as it came.
    """
    columns = list(STAGED_TYPES["merchant_sales"])
    selected = _selected("merchant_sales")
    selected.insert(columns.index("remittance_date"), f"{_GIVEN} as remittance_date_raw")
    return raw.selectExpr(*selected)


def stage_contracts(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(*_selected("contracts"))


def stage_claims(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(*_selected("claims"))


def stage_servicer_reimbursements(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(*_selected("servicer_reimbursements"))


def stage_all(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The staged form of every feed given that has one, named ``stg_<feed>``."""
    stages = [
        stage_merchant_sales, stage_contracts, stage_claims, stage_servicer_reimbursements,
    ]
    return {
        f"stg_{feed}": stage(raw[feed])
        for feed, stage in zip(STAGED_FEEDS, stages, strict=True)
        if feed in raw
    }
