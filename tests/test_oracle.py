"""Every query against its SQL twin, on the smallest data set."""

import os

import pytest
from compare import compare, duck

from rankforge.plans.oracle import oracles
from rankforge.plans.queries import registry

SF = "/root/testdata/sf0.001"
SQL = oracles()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(registry()))
def test_query(spark, con, name):
    df = registry()[name](spark, SF)
    if name in SQL:
        assert compare(df, SQL[name], con) is None
    else:
        assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(registry())


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
