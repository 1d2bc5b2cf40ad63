import compare
import pytest

from __spark_entry__ import entry, oracle_sql, queries

ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return compare.connect(sf_dir)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    assert compare.differences(queries()[name](spark, sf_dir), duck, ORACLES[name]) == []


def test_registry(spark):
    assert set(ORACLES) <= set(queries())
    assert entry(spark).count() == 10
