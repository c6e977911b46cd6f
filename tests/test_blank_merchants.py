"""Blank merchant ids on customers of the test's own: every hundredth customer
has one, at any number of customers, in the queries and in their SQL."""

import duckdb
import pytest

import __spark_entry__ as E
from tests.helpers import canon

N = 440
BLANK = {f"CUSTOMER#{k}" for k in (28, 128, 228, 328, 428)}


@pytest.fixture(scope="module")
def sf(tmp_path_factory):
    folder, con = tmp_path_factory.mktemp("blank"), duckdb.connect()
    con.execute(f"""COPY (SELECT k::BIGINT AS c_custkey, 'Customer#' || k AS c_name, 'AUTO' AS c_mktsegment
                    FROM range(1, {N + 1}) t(k)) TO '{folder}/customer.parquet' (FORMAT parquet)""")
    con.execute(f"""COPY (SELECT k::BIGINT AS o_orderkey, (1 + (k - 1) % {N})::BIGINT AS o_custkey,
                      100.25::DOUBLE AS o_totalprice, DATE '1998-03-01' AS o_orderdate
                    FROM range(1, {2 * N + 1}) t(k)) TO '{folder}/orders.parquet' (FORMAT parquet)""")
    return str(folder)


def _rows(spark, sf, name):
    """The query's rows as dicts, once they are found equal to its SQL's."""
    df, con = E.queries()[name](spark, sf), duckdb.connect()
    for t in ("customer", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    res, rows = con.execute(E.oracle_sql()[name]), df.collect()
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert canon(map(tuple, rows), df.columns) == canon(res.fetchall(), cols)
    return [r.asDict() for r in rows]


@pytest.mark.parametrize("name", ["attach_store", "merchant_id_match", "multi_mapped"])
def test_every_hundredth_customer_has_a_blank_merchant(spark, sf, name):
    assert {r["account_name"] for r in _rows(spark, sf, name) if r["merchant"] == ""} == BLANK


def test_blank_merchants_pair_with_every_blank_roster_id(spark, sf):
    pairs = [r for r in _rows(spark, sf, "merchant_id_match") if r["merchant"] == ""]
    targets = {(k // 5, 1 + k % 5) for k in range(1, N + 1) if k % 10 == 0}
    for who in BLANK:
        assert {(r["roster_studioid"], r["roster_locationid"]) for r in pairs if r["account_name"] == who} == targets


@pytest.mark.parametrize("name", ["merged_mappings", "final_list"])
def test_merged_rows_of_blank_merchants(spark, sf, name):
    rows = [r for r in _rows(spark, sf, name) if r["account_name"] in BLANK]
    assert {r["account_name"] for r in rows} == BLANK
    # each is merged at each location of a blank roster id
    assert len({(r["account_name"], r["roster_studioid"], r["roster_locationid"]) for r in rows}) == len(BLANK) * (N // 10)


def test_blank_merchants_are_not_unmatched(spark, sf):
    # their ids, which are not blank elsewhere, are no catch-all merchants, and the report counts the others alone
    left = {r["merchant"] for r in _rows(spark, sf, "catch_all")}
    assert left and not left & {"", *[who.split("#")[1].zfill(16) for who in BLANK]}
    assert sum(r["n_merchants"] for r in _rows(spark, sf, "unmatched_by_reason")) == len(left)
