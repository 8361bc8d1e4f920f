"""Every registered query against its SQL, over the smallest tables."""

import pytest

import __spark_entry__ as entry
from compare import connect, differences, rows_of
from conftest import SMALLEST

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALLEST)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    answer = QUERIES[name](spark, SMALLEST)
    if name not in SQL:  # compared with brute force elsewhere
        assert answer.count() > 0
        return
    assert differences(rows_of(duck.sql(SQL[name]).to_arrow_table()), rows_of(answer)) is None
