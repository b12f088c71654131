"""Every query against its SQL counterpart in another engine, over the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry_point
from loomhouse.plans.catalog import portable_queries
from loomhouse.plans.expected_sql import expected_sql

duckdb = pytest.importorskip("duckdb")
FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="no test tables")

EMPTY_AT_THIS_SIZE = {"scd2_new", "dq_fk", "dq_spelling"}
QUERIES, SQL = portable_queries(), expected_sql()


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for file in FOLDER.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield con
    con.close()


def settled(row):
    return tuple(round(v, 6) if isinstance(v, float) else v for v in row)


def in_order(found):
    return sorted(found, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()
    assert QUERIES.keys() <= entry_point.queries().keys()
    assert SQL.keys() <= entry_point.oracle_sql().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_same_rows(spark, tables, name):
    df = QUERIES[name](spark, str(FOLDER))
    columns = sorted(df.columns)
    expected = tables.execute(SQL[name])
    names = [d[0] for d in expected.description]
    assert sorted(names) == columns
    picked = [names.index(c) for c in columns]
    theirs = [settled(r[i] for i in picked) for r in expected.fetchall()]
    ours = [settled(r) for r in df.select(*columns).collect()]
    assert in_order(ours) == in_order(theirs)
    assert ours or name in EMPTY_AT_THIS_SIZE


def test_entry_is_not_empty(spark):
    assert entry_point.entry(spark).count() > 0
