"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as registry
from tests.conftest import SF
from tests.oracle import connect, differences

SQL = registry.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


OWN = [name for name, query in registry.queries().items() if query.__module__ == registry.__name__]


def test_every_query_has_sql():
    assert set(OWN) <= set(SQL)


@pytest.mark.parametrize("name", OWN)
def test_query_matches_sql(spark, connection, name):
    assert differences(registry.queries()[name](spark, SF), SQL[name], connection) is None


def test_entry(spark):
    found = {r["fetch_day"]: r["n_rows"] for r in registry.entry(spark).collect()}
    assert set(found) == {"20240115", "20240116"}
    assert sum(found.values()) == spark.read.parquet(f"{SF}/orders.parquet").count()
