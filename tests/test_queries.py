"""Every registered query against its SQL, and the contract of the registry."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from tests.compare import compare, connect
from tidemark.workload.oracle import ORACLE
from tidemark.workload.queries import QUERIES



@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql_and_the_reverse():
    assert sorted(QUERIES) == sorted(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, con, name):
    difference, _ = compare(QUERIES[name](spark, sf_dir), con, ORACLE[name])
    assert difference is None


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_the_entry_offers_them_all():
    assert set(QUERIES) <= set(driver.queries())
    assert set(ORACLE) <= set(driver.oracle_sql()) <= set(driver.queries())
