"""Every registered query against its SQL, on the smallest tables."""

import __spark_entry__ as entry
import pytest
from compare import connect, difference

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def connection(folder):
    return connect(folder)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, folder, name):
    if name in ORACLES:
        assert difference(spark, connection, folder, QUERIES[name], ORACLES[name]) is None
    else:
        assert QUERIES[name](spark, folder).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
