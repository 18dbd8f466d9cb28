"""Every registered query against its SQL form in DuckDB, on the smallest tables."""

import math
from decimal import Decimal

import duckdb
import pytest
from conftest import DATA

import __spark_entry__ as entry
from shelfline.plans.registry import QUERIES as SHOP

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, SQL = entry.queries(), entry.oracle_sql()
SLOW = {"stream_inventory_events"}  # covered by the streaming tests


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, (list, tuple)):
        return tuple(map(plain, value))
    return "nan" if isinstance(value, float) and math.isnan(value) else value


def ordered(found):
    return sorted(found, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_entry_runs(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_every_query_of_the_shop_has_sql():
    assert set(SQL) <= set(QUERIES)
    assert set(SHOP) <= set(SQL)


@pytest.mark.parametrize("name", sorted(set(SQL) - SLOW))
def test_query_equals_sql(spark, db, name):
    df = QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    got = ordered(tuple(map(plain, r)) for r in df.select(*cols).collect())
    cursor = db.execute(SQL[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == cols
    places = [names.index(c) for c in cols]
    expected = ordered(tuple(plain(r[i]) for i in places) for r in cursor.fetchall())
    assert got == expected
