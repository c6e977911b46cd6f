"""Readers for the four pipeline inputs and the adapter that derives them
from the driver's TPC-H-like tables."""

from acctrecon.sources.fixtures import FIXTURE_REPORT_DATE, fixture_inputs, write_account_lines
from acctrecon.sources.readers import ingest_accounts, ingest_report, read_accounts_csv, read_inputs, read_table

__all__ = ["FIXTURE_REPORT_DATE", "fixture_inputs", "ingest_accounts", "ingest_report", "read_accounts_csv", "read_inputs",
           "read_table", "write_account_lines"]
