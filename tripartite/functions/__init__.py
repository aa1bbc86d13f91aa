"""SQL expressions shared by the operators. All of them run JVM-side."""

from tripartite.functions.expressions import (
    aging_bucket,
    day,
    days_between,
    describe,
    holds,
    money_total,
    parse_date,
    percent_text,
    ratio,
    severity_rank,
    strict_date,
    text,
)

__all__ = [
    "aging_bucket",
    "day",
    "days_between",
    "describe",
    "holds",
    "money_total",
    "parse_date",
    "percent_text",
    "ratio",
    "severity_rank",
    "strict_date",
    "text",
]
