"""Every registered query against its SQL in another engine."""

from __future__ import annotations

import pytest
from oracle_check import compare, connect

from tillhouse.registry.oracle import ORACLE
from tillhouse.registry.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, con, sf_dir, name):
    ok, rows, note = compare(spark, con, name, QUERIES[name], ORACLE[name], sf_dir)
    assert ok, note
    assert rows > 0


def test_entry_runs():
    import __spark_entry__ as driver

    assert set(driver.queries()) >= set(QUERIES) and set(driver.oracle_sql()) >= set(ORACLE)
    assert set(driver.oracle_sql()) <= set(driver.queries())
