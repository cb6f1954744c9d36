"""Every registered query with an SQL twin gives the same rows on the smallest data set."""

import pytest

import __spark_entry__ as entry
from compare import oracle_connection, rows_of
from conftest import SF

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return oracle_connection(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = rows_of(df.columns, df.collect())
    if name in ORACLE:
        cur = duck.execute(ORACLE[name])
        assert got == rows_of([d[0] for d in cur.description], cur.fetchall())
    else:
        assert got[1]


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() == 3
