"""Plan assertions: no nested-loop or cartesian joins anywhere, filters and
column pruning reach the parquet scan."""

import contextlib
import io

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", ["attach_store", "match_status", "master_list",
                                  "exact_roster_match", "parent_studio_match",
                                  "merchant_id_match", "catch_all", "all_mappings",
                                  "final_list", "unmatched_report", "multi_location"])
def test_no_nested_loop_or_cartesian(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    assert "BroadcastNestedLoopJoin" not in plan
    assert "CartesianProduct" not in plan


def test_scan_pushdown_and_pruning(spark):
    plan = _plan(E.queries()["attach_store"](spark, SF))
    # all payments are read: no range of order dates is filtered
    assert not [ln for ln in plan.splitlines() if "PushedFilters" in ln and "(o_orderdate" in ln
                and "Than" in ln], plan
    schemas = [ln for ln in plan.splitlines() if "ReadSchema" in ln and "o_orderkey" in ln]
    assert schemas and all("o_orderpriority" not in ln for ln in schemas)


def _attach_plan(spark, n_accounts):
    """The plan of C1 over written tables of 200,000 payments and ``n_accounts`` accounts."""
    import tempfile

    from pyspark.sql import functions as F

    from acctrecon.operators.attach import attach_by_name

    root = tempfile.mkdtemp(prefix="acctrecon-plan-")
    spark.range(200_000).select(F.concat(F.lit("N"), "id").alias("account_name"),
                                F.sha2(F.col("id").cast("string"), 512).alias("v")).write.mode(
        "overwrite").parquet(f"{root}/p")
    spark.range(n_accounts).select(F.concat(F.lit("n"), "id").alias("account_name"),
                                   F.sha2(F.col("id").cast("string"), 512).alias("store_id")).write.mode(
        "overwrite").parquet(f"{root}/a")
    return _plan(attach_by_name(spark.read.parquet(f"{root}/p"), spark.read.parquet(f"{root}/a")))


def test_small_accounts_leave_the_payments_in_place(spark):
    plan = _attach_plan(spark, 500)
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    # too large to send: both sides are shuffled
    plan = _attach_plan(spark, 200_000)
    assert "SortMergeJoin" in plan and "hashpartitioning" in plan


def test_the_union_is_read_three_times_at_most(spark):
    plan = _plan(E.queries()["final_list"](spark, SF))
    assert 1 <= len({ln for ln in plan.splitlines() if ln.startswith("Location:") and "all_mappings" in ln}) <= 1
    scans = [ln for ln in plan.split("===== Subqueries")[0].splitlines() if "Scan parquet" in ln and "(" in ln
             and not ln.strip()[:1] == "("]
    assert len(scans) <= 8, scans
