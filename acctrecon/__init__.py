"""acctrecon: payment-to-location reconciliation and revenue attribution on
Spark DataFrames."""

from acctrecon.plans.pipeline import Reconciliation, as_report

__all__ = ["Reconciliation", "as_report"]
