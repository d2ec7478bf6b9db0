import decimal
import glob
import os

import duckdb
import pytest

import __spark_entry__ as e
from almoneda import core_queries, reference_queries, view_queries


def norm(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return float(f"{v:.9g}")
    return tuple(map(norm, v)) if isinstance(v, (list, tuple)) else v


@pytest.fixture(scope="module")
def db(sf):
    c = duckdb.connect()
    for p in glob.glob(f"{sf}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


def test_entry(spark):
    assert e.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("name", sorted(core_queries.SQL | reference_queries.SQL | view_queries.SQL))
def test_query_equals_sql(spark, sf, db, name):
    df = e.queries()[name](spark, sf)
    r = db.execute(e.oracle_sql()[name])
    names = sorted(df.columns)
    assert sorted(x[0] for x in r.description) == names
    at = [[x[0] for x in r.description].index(k) for k in names]
    want = sorted(repr([norm(x[i]) for i in at]) for x in r.fetchall())
    assert sorted(repr([norm(x[k]) for k in names]) for x in df.collect()) == want
