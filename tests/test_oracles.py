import oracle
import pytest

import __spark_entry__ as entry
from conftest import SF_DIR

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    found = entry.queries()[name](spark, SF_DIR)
    assert oracle.compare(found, duck, SQL[name]) is None


def test_every_sql_has_a_query():
    assert set(SQL) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
