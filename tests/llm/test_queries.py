from __future__ import annotations

import pytest
from oracle_check import compare, connect

from tillhouse.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, sf_dir, name):
    ok, rows, note = compare(spark, connect(sf_dir), name, queries.QUERIES[name], queries.ORACLE[name], sf_dir)
    assert ok and rows, note


def test_every_operator_is_registered_once():
    import __spark_entry__ as driver

    for n in range(1, 14):
        assert len([q for q in driver.queries() if q.startswith(f"op{n}_")]) == 1
    assert "pipeline" in driver.queries()
