"""Every query with an oracle against DuckDB on the smallest fixture."""

import pytest

import __spark_entry__ as E
from usagelake.plans.catalog import QUERIES
from conftest import SF_SMALL
from tools.oracle_check import duck, rows_of

SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF_SMALL)
    cur = con.execute(SQL[key])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(dcols, cur.fetchall())


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(SQL) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["package_name", "date", "n"]
    assert df.count() > 0
