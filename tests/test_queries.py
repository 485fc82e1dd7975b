"""Every query of the reference's operators against its SQL, on the smallest tables."""

import glob
import os
from collections import Counter
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry
from veinloom.plans import registry

SF = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, Decimal):
        return float(v)
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


UNIQUE = {id(f): k for k, f in registry.queries().items()}.values()


@pytest.mark.parametrize("name", sorted(UNIQUE))
def test_query(spark, duck, name):
    found = registry.queries()[name](spark, SF)
    rows = Counter(tuple(plain(v) for v in r) for r in found.collect())
    sql = registry.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    columns = ", ".join(f'"{c}"' for c in found.columns)
    assert set(found.columns) == set(duck.sql(sql).columns)
    assert rows == Counter(tuple(plain(v) for v in r) for r in duck.sql(f"SELECT {columns} FROM ({sql})").fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
