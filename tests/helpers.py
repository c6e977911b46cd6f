"""Shared test helpers: typed input frames, DuckDB mirrors, comparison."""

from __future__ import annotations

import datetime
import decimal
import random

import duckdb

from acctrecon import schemas as S
from acctrecon.oracle import pipeline_sql

REPORT = datetime.date(1998, 6, 1)
PREV = datetime.date(1998, 5, 1)
EARLIER = datetime.date(1998, 4, 1)


def D(x) -> decimal.Decimal | None:
    return None if x is None else decimal.Decimal(str(x)).quantize(decimal.Decimal("0.0001"))


def frames(spark, payments, accounts, locations, roster):
    acc = [(a[0], a[1], None, a[2], None, None, None, a[3] if len(a) > 3 else "CC",
            a[4] if len(a) > 4 else None) for a in accounts]
    pay = [(p[0], p[1], p[2], p[3], p[4], D(p[5]), p[6], D(p[7]), D(p[8]), "f") for p in payments]
    loc = [(l[0], l[1], l[2], l[3], None) for l in locations]
    return {
        "payments": spark.createDataFrame(pay, S.PAYMENTS),
        "accounts": spark.createDataFrame(acc, S.ACCOUNTS),
        "locations": spark.createDataFrame(loc, S.LOCATIONS),
        "roster": spark.createDataFrame(roster, S.ROSTER),
    }


def duck_for(inputs) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name, df in inputs.items():
        con.register(name, df.toArrow())
    return con


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    return v


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def assert_same(spark_df, con, name):
    srows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(pipeline_sql(name))
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(spark_df.columns) == sorted(dcols), (name, spark_df.columns, dcols)
    a, b = canon(srows, spark_df.columns), canon(drows, dcols)
    assert a == b, (name, len(a), len(b), [x for x in a if x not in b][:3],
                    [x for x in b if x not in a][:3])


def random_inputs(seed: int):
    """Small inputs drawn from tiny domains so that keys collide: duplicate
    names, NULL and blank ids, NULL studios, location 0, NULL merchants,
    zero and NULL amounts, two roster months."""
    r = random.Random(seed)

    def pick(xs, p_null=0.0):
        return None if r.random() < p_null else r.choice(xs)

    names = [f"n{i}" for i in range(6)]
    stores = [f"S{i}" for i in range(7)]
    merchants = [f"M{i}" for i in range(10)]
    # odd seeds may carry a NULL merchant, which empties the merchant-id and
    # catch-all levels through NOT IN; even seeds exercise those levels
    p_null_merchant = 0.04 if seed % 2 else 0.0
    accounts = []
    for i in range(10):
        nm = r.choice(names)
        accounts.append((nm.upper() if r.random() < 0.3 else nm, 1000 + i, pick(stores, 0.05)))
    payments = []
    for _ in range(28):
        vol = r.choice([0, 0, 10, 12.5, 100.0001, 3, None, 7.77])
        rev = r.choice([0, 1, 0.25, None, 2.5])
        payments.append((r.choice(["199806", "199806", "199805"]), pick(names + ["zz"]),
                         pick(merchants, p_null_merchant), r.choice(["A", "B"]),
                         r.choice(["CAD", "EUR"]),
                         vol, r.choice([1, 2, 3, None]), rev, r.choice([0.5, 0, None])))
    locations = []
    for _ in range(16):
        studio = r.choice([1, 2, 3, 4, None]) if r.random() < 0.95 else None
        loc = r.choice([1, 2, 3, 98, 98, 0])
        mid = r.choice(stores + ["", None, "", "X1"])
        locations.append((studio, loc, f"acct{r.randint(0, 99)}", mid))
    roster = []
    for c in range(1, 9):
        for d in (EARLIER, PREV, REPORT):
            if r.random() < 0.75:
                roster.append((c, d, pick([1, 2, 3, 4], 0.25), pick([0, 1, 2, 3], 0.2),
                               pick([1, 2, 3, 4], 0.6), pick(merchants[:6] + ["", "M1"], 0.3)))
    return payments, accounts, locations, roster
