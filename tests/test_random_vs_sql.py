"""Property check: every stage on small random inputs equals the
warehouse-shaped SQL (OR joins, NOT IN, fan-out + DISTINCT) run by DuckDB."""

import pytest

from acctrecon import Reconciliation, as_report
from tests.helpers import REPORT, assert_same, duck_for, frames, random_inputs

STAGES = {
    "attach_store": "facts", "report_month": "report_month", "active_locations": "active_locations",
    "single_location": "single_location", "unmatched_store": "unmatched_store",
    "multi_location": "multi_location", "match_status": "match_status",
    "master_list": "master_list", "roster_backfilled": "roster_backfilled",
    "exact_roster_match": "exact_roster_match", "parent_studio_match": "parent_studio_match",
    "merchant_id_match": "merchant_id_match", "catch_all": "catch_all",
    "even_distribution": "even_distribution", "exclusive_location": "exclusive_location",
    "shared_location": "shared_location", "all_mappings": "all_mappings",
    "multi_mapped": "multi_mapped", "merged_mappings": "merged_mappings",
    "final_list": "final_list", "unmatched_report": "unmatched_report",
    "unmatched_by_reason": "unmatched_by_reason",
}


@pytest.mark.parametrize("seed", [207, 211, 212])
def test_random_inputs_match_sql(spark, seed):
    inputs = frames(spark, *random_inputs(seed))
    con = duck_for(inputs)
    rec = Reconciliation(**inputs, report_date=REPORT.isoformat())
    for sql_name, attr in STAGES.items():
        assert_same(as_report(getattr(rec, attr)), con, sql_name)


def test_hot_key_inputs_match_sql(spark):
    """One account name (so one store and merchant) holds over a third of the
    payment rows; every stage must still equal the SQL."""
    payments, accounts, locations, roster = random_inputs(212)
    hot = payments[0]
    payments = payments + [(hot[0], hot[1], hot[2], hot[3], cur, vol, 1, 1, 1)
                           for cur in ("CAD", "EUR") for vol in range(1, 9)]
    inputs = frames(spark, payments, accounts, locations, roster)
    con = duck_for(inputs)
    rec = Reconciliation(**inputs, report_date=REPORT.isoformat())
    for sql_name, attr in STAGES.items():
        assert_same(as_report(getattr(rec, attr)), con, sql_name)
