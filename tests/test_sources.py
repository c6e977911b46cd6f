"""Input hygiene for the account file, and the fixture adapter."""

import contextlib
import io
import os
import tempfile

from pyspark.sql import functions as F

from acctrecon.sources import fixture_inputs, read_accounts_csv
from acctrecon.sources.readers import related_accounts

HEADER = ("Account Name,Account ID,Enabled Date,Store ID,Store Password,Contacts Name,Currency,"
          "Sales Region,Service User Number,Processing Type,Related CC Account")
SYNTHETIC = [
    "Shop Ünë,1000000001,2020-01-02 10:42:23.0,ST-1,pw-secret-1,Person One,CAD,CAN,,CC,",
    "Shop Ünë,1000000002,12:34.5,ST-1,pw-secret-2,Person Two,CAD,CAN,,DD,1000000001",
    "Shop Two,1000000003,07:08.9,ST-2,pw-secret-3,Person Three,GBP,UK,77,DD,1000000001; 1000000009",
]


def _write_csv():
    d = tempfile.mkdtemp(prefix="acctrecon-csv-")
    path = os.path.join(d, "accounts.csv")
    with open(path, "wb") as f:
        f.write(b"\xef\xbb\xbf" + "\r\n".join([HEADER, *SYNTHETIC]).encode("utf-8") + b"\r\n")
    return path


def test_accounts_csv_never_reads_sensitive_columns(spark):
    df = read_accounts_csv(spark, _write_csv())
    assert "_unread_5" not in df.columns and "_unread_6" not in df.columns
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    read_schema = [ln for ln in buf.getvalue().splitlines() if "ReadSchema" in ln]
    assert read_schema and all("_unread" not in ln for ln in read_schema)
    rows = df.orderBy("account_id").collect()
    assert [r.account_id for r in rows] == [1000000001, 1000000002, 1000000003]
    assert rows[0].account_name == "Shop Ünë"                     # BOM stripped, Unicode kept
    assert rows[0].enabled_date is not None and rows[1].enabled_date is None
    assert all("secret" not in str(tuple(r)) and "Person" not in str(tuple(r)) for r in rows)
    assert rows[2].related_account == "1000000001; 1000000009"


def test_related_accounts_split(spark):
    df = read_accounts_csv(spark, _write_csv())
    got = sorted(tuple(r) for r in related_accounts(df).collect())
    assert got == [(1000000002, 1000000001), (1000000003, 1000000001), (1000000003, 1000000009)]


def test_fixture_counts_sf0001(spark):
    inp = fixture_inputs(spark, "/root/testdata/sf0.001")
    assert inp["accounts"].count() == 158
    assert inp["locations"].count() == 180
    assert inp["roster"].count() == 180
    months = inp["payments"].groupBy("month").count().collect()
    assert len(months) > 5 and {m.month[4:] for m in months} == {"06"}    # every year's orders
    odd = inp["payments"].where("not merchant rlike '^[0-9]{16}$'").select("merchant").distinct().collect()
    assert "" in {r.merchant for r in odd} and any((r.merchant or "").startswith("M") for r in odd)
    assert inp["payments"].where("merchant is null").count() > 0


def test_read_inputs(spark):
    from acctrecon.sources.readers import read_inputs
    from tests.helpers import frames, random_inputs

    root = tempfile.mkdtemp(prefix="acctrecon-inputs-")
    given = frames(spark, *random_inputs(3))
    for name, df in given.items():
        df.write.mode("overwrite").parquet(f"{root}/{name}")
    back = read_inputs(spark, root)
    assert {n: back[n].count() for n in back} == {n: given[n].count() for n in given}
    assert all(back[n].columns == given[n].columns for n in given)
