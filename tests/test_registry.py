import pytest

import __spark_entry__ as entry
from quaymark.plans import registry
from tests.compare import assert_equal, database
from tests.conftest import DATA


@pytest.fixture(scope="module")
def db():
    return database(DATA)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_its_sql(spark, db, name):
    assert_equal(registry.QUERIES[name](spark, DATA), db, registry.ORACLE_SQL[name])


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
