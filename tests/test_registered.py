"""Every registered query runs, and equals its SQL where it has one."""

import pytest

import __spark_entry__ as entry
from checks.compare import connect, difference
from conftest import SF

QUERIES, SQL = entry.queries(), entry.oracle_sql()
LLM = {*(entry.llm.QUERIES if entry.llm else ()), "pipeline"}      # these have tests of their own


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in LLM])
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    if name in SQL:
        assert difference(df, con, SQL[name]) is None
    else:
        assert df.count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
