import pytest

from shoalframe import catalogue
from tests.conftest import SF
from tests.oracle import connect, same


@pytest.fixture(scope="module")
def db():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_query_equals_its_sql(spark, db, name):
    same(spark, db, SF, catalogue.QUERIES[name], catalogue.SQL[name])


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.SQL)))
def test_query_runs(spark, name):
    assert catalogue.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 6000
    assert set(entry.oracle_sql()) <= set(entry.queries())
