import os
from decimal import Decimal

import __spark_entry__ as entry
import duckdb
import pytest

from lexmill.plans import queries as plain

SMALL = "/root/testdata/sf0.001"


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 10 and rows[0]["text"]


def test_every_query_with_sql_exists():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def shown(value):
    """Values as they are compared: floats and decimals by six places."""
    return round(float(value), 6) if isinstance(value, (float, Decimal)) else value


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for f in os.listdir(SMALL):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SMALL}/{f}'")
    return con


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no tables here")
@pytest.mark.parametrize("name", sorted(plain.ORACLE_SQL))
def test_queries_agree_with_sql(spark, tables, name):
    found = tables.execute(entry.oracle_sql()[name])
    columns = sorted(c[0] for c in found.description)
    place = [[c[0] for c in found.description].index(c) for c in columns]
    want = sorted(repr([shown(r[k]) for k in place]) for r in found.fetchall())
    own = entry.queries()[name](spark, SMALL)
    assert sorted(own.columns) == columns and sorted(repr([shown(r[c]) for c in columns]) for r in own.collect()) == want
