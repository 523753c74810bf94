"""Every registered query against its statement, at the smallest scale."""

import pytest

from checks.oracles import oracle_sql
from checks.queries import QUERIES
from tools.compare import connect, rows

from .conftest import SF

STATEMENTS = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(STATEMENTS)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    got = rows(QUERIES[name](spark, SF).toPandas())
    want = rows(con.sql(STATEMENTS[name]).df())
    assert got == want
