from __future__ import annotations

import pytest

from check_oracles import difference, duck, duck_result, spark_result
from verification.oracles import oracles
from verification.queries import queries

SF_DIR = "/root/testdata/sf0.001"
SQL = oracles()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(SQL) == set(queries())


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_its_oracle(spark, con, name):
    found = spark_result(queries()[name](spark, SF_DIR))
    assert found[1], "no rows to compare"
    assert difference(found, duck_result(con, SQL[name])) is None


def test_entry(spark):
    import __spark_entry__ as driver

    assert driver.entry(spark).count() > 0
    assert set(SQL) <= set(driver.oracle_sql()) <= set(driver.queries())
