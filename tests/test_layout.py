"""SC4-SC6: idempotent stage writes with a distribution and sort key."""

import glob
import os
import tempfile

import pyarrow.parquet as pq

from acctrecon.plans.layout import write_stage


def test_write_stage_is_idempotent_and_sorted(spark):
    df = spark.createDataFrame([(f"M{i % 7}", i % 5, i) for i in range(200)],
                               "merchant string, studioid int, v int")
    path = os.path.join(tempfile.mkdtemp(prefix="acctrecon-layout-"), "stage")
    for _ in range(2):      # drop-and-rebuild: the second write replaces the first
        write_stage(df, path, distribute_by=["merchant"], sort_by=["merchant", "studioid"],
                    partitions=3)
    back = spark.read.parquet(path)
    assert back.count() == 200
    files = glob.glob(os.path.join(path, "*.parquet"))
    assert 1 <= len(files) <= 3
    seen = set()
    for f in files:
        t = pq.read_table(f).to_pandas()
        keys = list(zip(t["merchant"], t["studioid"]))
        assert keys == sorted(keys)                     # sorted within each file
        merchants = set(t["merchant"])
        assert not merchants & seen                     # each merchant in one file
        seen |= merchants


def test_rebuilt_stage_has_its_layout(spark):
    from acctrecon import Reconciliation
    from acctrecon.plans.layout import LAYOUT
    from acctrecon.plans.versions import StageTable
    from acctrecon.sources import FIXTURE_REPORT_DATE, fixture_inputs

    path = os.path.join(tempfile.mkdtemp(prefix="acctrecon-layout-"), "master")
    with Reconciliation(**fixture_inputs(spark, "/root/testdata/sf0.001"), report_date=FIXTURE_REPORT_DATE) as rec:
        assert not [stage for stage in LAYOUT if not hasattr(type(rec), stage)]
        version = rec.write("master_list", path)
        assert StageTable(spark, path).read().count() == rec.master_list.count() > 0
    keys = [k for f in glob.glob(os.path.join(path, "data", version.name, "*.parquet"))[:1]
            for k in pq.read_table(f).column("merchant").to_pylist() if k is not None]
    assert keys and keys == sorted(keys)


def test_layout_names_stages_and_their_columns(spark):
    from acctrecon import Reconciliation
    from acctrecon.plans.layout import LAYOUT
    from tests.helpers import frames

    rec = Reconciliation(**frames(spark, [], [], [], []), cut=False)
    for stage in ("facts", "report_month", "active_locations", "single_location", "unmatched_store",
                  "multi_location", "master_list", "exact_roster_match"):
        distribute_by, sort_by = LAYOUT[stage]
        assert {*distribute_by, *sort_by} <= set(getattr(rec, stage).columns), stage


def test_write_bucketed(spark):
    from acctrecon.plans.layout import write_bucketed

    path = tempfile.mkdtemp(prefix="acctrecon-buckets-")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS layout_test LOCATION '{path}'")
    df = spark.createDataFrame([(f"M{i % 7}", i) for i in range(100)], "merchant string, v int")
    for _ in range(2):
        write_bucketed(df, "layout_test.stage", buckets=3, bucket_by=["merchant"], sort_by=["merchant"])
    back = spark.table("layout_test.stage")
    assert back.count() == 100
    assert len({f for f in back.inputFiles()}) <= 3
    plan = back.groupBy("merchant").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan       # the buckets already distribute the key
    spark.sql("DROP DATABASE layout_test CASCADE")
