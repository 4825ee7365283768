"""The registered queries against DuckDB, values and types."""

import pytest

from checks.compare import compare, connect
from clientele.llm.oracle import SQL
from clientele.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_all_operators_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", SQL)
def test_equals_duckdb(spark, duck, name):
    assert compare(QUERIES[name](spark, SF), duck, SQL[name]) == []


@pytest.mark.parametrize("name", ["op7_line_dedup", "op10_secret_scan"])
def test_native_plans_run_no_python(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
