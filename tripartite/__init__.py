"""Three-party reconciliation on Spark.

Sales, contracts, claims and payments go in as DataFrames; breaks between them,
their daily history, reports and data-quality results come out as DataFrames.
"""

from tripartite.session import tune

__all__ = ["tune"]
