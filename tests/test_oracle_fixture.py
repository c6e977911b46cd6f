"""The driver's gate, locally: queries() against oracle_sql() in DuckDB on
the fixture adapter (sf0.001), plus the entry() smoke check."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tests.helpers import canon

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("customer", "orders"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t)}.parquet')")
    return c


OWN = [n for n in sorted(E.queries()) if E.llm is None or n not in {*E.llm.QUERIES, "pipeline"}]


@pytest.mark.parametrize("name", OWN)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert canon([tuple(r) for r in df.collect()], df.columns) == canon(res.fetchall(), dcols)


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(E.oracle_sql())


def test_the_fixture_can_fail_the_filters(spark):
    q = E.queries()
    assert q["report_month"](spark, SF).count() < q["attach_store"](spark, SF).count()
    assert q["merchant_id_valid"](spark, SF).count() < q["merchant_id_match"](spark, SF).count()
    codes = {r.location_status for r in q["match_status"](spark, SF).collect()}
    assert len(codes) >= 3


def test_no_folder_is_an_error(spark, monkeypatch):
    from acctrecon.plans import cut

    monkeypatch.setattr(cut, "checkpoint_root", lambda s: None)
    with pytest.raises(ValueError):
        cut.run_folder(spark)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "map" in df.columns and "roster_studioid" in df.columns
