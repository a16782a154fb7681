"""Every query with SQL gives the same rows as the SQL on the same tables."""

import pytest

from workload import registry
from workload.compare import compare, connect



def names():
    from workload import matching, periods, plans, profiling, records

    return [n for m in (profiling, periods, matching, records, plans) for n in m.ORACLES]


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", names())
def test_same_as_sql(spark, con, sf_dir, name):
    same, note = compare(spark, con, registry.queries()[name], registry.oracles()[name], sf_dir)
    spark.catalog.clearCache()
    assert same, note


def test_every_sql_has_a_query():
    assert set(registry.oracles()) <= set(registry.queries())
