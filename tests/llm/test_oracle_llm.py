"""Queries with SQL equal DuckDB; the others return one row per row of their table."""

import pytest

from oracle import compare
from txnscore.llm import catalog

SF_SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_matches_duckdb(spark, name):
    ok, n, detail = compare(spark, name, catalog.QUERIES[name], catalog.ORACLE[name], SF_SMALL)
    assert ok and n > 0, detail


def test_no_query_uses_python_where_none_is_allowed(spark):
    for name in ("op6_quality_rules", "op8_chat_formatting"):
        plan = catalog.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_tasks_on_executors_find_the_package(spark):
    from txnscore.llm.common import ship
    ship(spark)
    assert spark.sparkContext._txnscore_shipped
