"""Every named query equals its SQL statement."""

import pytest

import __spark_entry__ as driver
from retinue.catalog import ORACLE_SQL, QUERIES
from tests.conftest import SF_DIR
from tests.oracle import compare


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    _rows, problem = compare(QUERIES[name](spark, SF_DIR), duck, ORACLE_SQL[name])
    assert not problem


def test_entry_has_rows(spark):
    assert driver.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(driver.oracle_sql()) <= set(driver.queries())
