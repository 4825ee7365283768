"""Every registered query against DuckDB, values and types; and the shape of the plans."""

import re

import pytest
from conftest import SF

from __spark_entry__ import entry
from checks.compare import compare, connect
from checks.oracle import oracle_sql
from clientele.plans.views import VIEWS
from clientele.queries import registry

QUERIES, SQL = registry(), oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_equals_duckdb(spark, duck, name):
    assert compare(QUERIES[name](spark, SF), duck, SQL[name]) == []


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize(
    "name",
    [
        "link_transactions",
        "fact_transactions",
        "customer_lifetime_value_strict",
        "churned_customers_by_location",
        "performance_by_session",
    ],
)
def test_equals_duckdb_without_broadcast_by_size(spark, duck, name, forced_shuffle):
    """The way large tables take: hot keys apart (guests are one), the rest shuffled."""
    assert compare(QUERIES[name](spark, SF), duck, SQL[name]) == []


@pytest.mark.parametrize("name", VIEWS)
def test_plans(spark, name, forced_shuffle):
    """With tables too large to broadcast: no product of tables, no single-task window or sort."""
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    for line in plan.splitlines():
        # a single partition takes global aggregates and the window over months only
        if "SinglePartition" in line:
            assert re.search(r"Exchange SinglePartition", line)
            assert "Window" not in line
