"""Every query against its SQL on the smallest tables, and the driver contract."""

import pytest

import __spark_entry__ as contract
from quire.trial.catalogue import QUERIES
from quire.trial.oracle import ORACLE
from tests.compare import differences, sql_connection

# No SQL twin: sketched counts, bytes of files.
WITHOUT_SQL = {"column_profile_sketched", "table_sizes"}


@pytest.fixture(scope="module")
def connection(small_folder):
    with sql_connection(small_folder) as c:
        yield c


def test_every_query_has_sql():
    assert QUERIES.keys() - contract.oracle_sql().keys() == WITHOUT_SQL
    assert QUERIES.keys() <= contract.queries().keys() and ORACLE.keys() <= contract.oracle_sql().keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equal_to_sql(spark, connection, small_folder, name):
    assert differences(contract.queries()[name](spark, small_folder), connection, contract.oracle_sql()[name]) == []


@pytest.mark.parametrize("name", sorted(WITHOUT_SQL))
def test_runs(spark, small_folder, name):
    assert contract.queries()[name](spark, small_folder).count() > 0


def test_entry(spark, small_folder):
    assert contract.entry(spark).count() > 0


def test_sketched_distinct_is_close(spark, small_folder):
    from quire.trial import mapping

    profile = contract.queries()["column_profile_sketched"](spark, small_folder)
    sketched = {r["column_name"]: r["approx_distinct"] for r in profile.collect()}
    exact = mapping.sales(spark, small_folder).select("VEISBN").distinct().count()
    assert abs(sketched["VEISBN"] - exact) <= 0.15 * exact
