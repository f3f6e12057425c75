"""Every query that has an oracle gives the oracle's rows over the smallest tables."""

import datetime
import glob
import math
import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as contract
from chronolake.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def plain(v):
    if isinstance(v, (float, Decimal)) and not math.isnan(v):
        return f"{float(v):.9g}"
    if isinstance(v, bool):
        return str(int(v))
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return "~" if v is None else str(v)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_against_oracle(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    found = duck.execute(catalog.ORACLE_SQL[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(df.columns)
    want = sorted(tuple(map(plain, r)) for r in found.fetchall())
    assert sorted(tuple(plain(r[c]) for c in columns) for r in df.collect()) == want


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)))
def test_without_oracle(spark, name):
    rows = catalog.QUERIES[name](spark, SF).collect()
    again = catalog.QUERIES[name](spark, SF).repartition(3).collect()
    assert rows and sorted(map(str, rows)) == sorted(map(str, again))


def test_contract(spark):
    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
