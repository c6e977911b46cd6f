"""Whole-pipeline plans, lineage cuts, write layout and session settings."""

from acctrecon.plans.pipeline import Reconciliation

__all__ = ["Reconciliation"]
