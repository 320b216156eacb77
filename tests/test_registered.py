"""Every registered query against its SQL at the smallest size."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_DIR
from tests.oracle_check import compare, connect
from workload.oracle import ORACLE
from workload.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_catalog_query_has_sql_and_is_registered():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 7
    assert [r.item_count for r in rows] == sorted((r.item_count for r in rows), reverse=True)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, con, name):
    problem, n = compare(spark, con, SF_DIR, name, QUERIES[name], ORACLE[name])
    assert problem is None and n > 0
