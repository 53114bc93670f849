import pytest

import __spark_entry__ as entry_points
from check_sql import connect, difference

from given_tables import TESTDATA

SQL = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(TESTDATA)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, duck, name):
    expected = duck.sql(SQL[name]).to_arrow_table()
    assert difference(entry_points.queries()[name](spark, TESTDATA).toArrow(), expected) is None


def test_every_twin_has_a_query():
    assert set(SQL) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).count() == 6
