"""
and the size of the documented losses on the sf0.001 fixture."""

import decimal

import pytest
from pyspark.sql import functions as F

from acctrecon import Reconciliation
from acctrecon.sources import FIXTURE_REPORT_DATE, fixture_inputs

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rec(spark):
    return Reconciliation(**fixture_inputs(spark, SF), report_date=FIXTURE_REPORT_DATE)


def test_exclusive_and_shared_partition_even_distribution(rec):
    s12 = rec.even_distribution.select("reportdate", "storeid", "agent", "merchant", "cur",
                                       "account_name", "txn_volume", "roster_studioid",
                                       "roster_locationid").distinct()
    s13, s14 = rec.exclusive_location, rec.shared_location
    assert s13.count() + s14.count() == s12.count()
    keys13 = s13.select("roster_studioid", "roster_locationid").distinct()
    keys14 = s14.select("roster_studioid", "roster_locationid").distinct()
    assert keys13.join(keys14, ["roster_studioid", "roster_locationid"]).count() == 0


def test_even_shares_sum_back_within_one_studio(rec):
    """T17: conserved when all of a merchant's rows share the same locations."""
    s9 = rec.parent_studio_match
    one_studio = (s9.groupBy("merchant").agg(F.count_distinct("roster_studioid").alias("n"))
                  .where("n = 1").select("merchant"))
    orig = (s9.join(one_studio, "merchant")
            .select("merchant", "storeid", "agent", "cur", "account_name", "txn_volume").distinct()
            .groupBy("merchant").agg(F.sum("txn_volume").alias("orig")))
    spread = (rec.even_distribution.join(one_studio, "merchant")
              .groupBy("merchant").agg(F.sum("txn_volume").alias("spread"),
                                       F.count(F.lit(1)).alias("rows")))
    rows = orig.join(spread, "merchant").collect()
    assert rows
    for r in rows:   # each share is rounded to 1e-10
        assert abs(r.orig - r.spread) <= decimal.Decimal("1e-10") * r.rows, r


def test_merge_partition_and_documented_losses(rec):
    s15, s16, s18 = rec.all_mappings, rec.multi_mapped, rec.final_list
    key = [F.col("roster_studioid"), F.coalesce(F.col("roster_locationid"), F.lit(0))]
    multi_keys = s16.select(*[k.alias(f"k{i}") for i, k in enumerate(key)]).distinct()
    with_studio = s15.where(F.col("roster_studioid").isNotNull())
    in_multi = with_studio.join(multi_keys, (key[0] == F.col("k0")) & (key[1] == F.col("k1")),
                                "left_semi")
    # S16 and its complement partition the rows whose studio is known
    assert in_multi.count() == s16.count()
    untouched = s18.where(F.col("map") != 14)
    assert untouched.count() + s16.count() == with_studio.count() + \
        untouched.where(F.col("roster_studioid").isNull()).count()
    # T5: with a non-empty S16 every NULL-studio row of S15 is dropped
    assert s15.where(F.col("roster_studioid").isNull()).count() == 70
    assert untouched.where(F.col("roster_studioid").isNull()).count() == 0
    # T3: multi-mapped rows with a NULL location reach neither branch
    assert s16.where(F.col("roster_locationid").isNull()).count() == 100
    # T4: every catch-all row shares the sentinel key, so all leave as 14
    assert s18.where(F.col("map") == 13).count() == 0


def test_close_removes_the_run_cuts(spark):
    import os

    from acctrecon.plans.cut import checkpoint_root

    root = checkpoint_root(spark)
    with Reconciliation(**fixture_inputs(spark, SF), report_date=FIXTURE_REPORT_DATE) as r:
        n = r.master_list.count()
        folder = r._folder
        assert folder.startswith(root.rstrip("/")) and os.path.isdir(folder)
    assert n > 0 and not os.path.exists(folder)
