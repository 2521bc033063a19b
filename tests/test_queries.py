"""Every query against its SQL, and the shape of the plans."""

import re

import pytest
from check_queries import compare, connect

import __spark_entry__ as entry
from repledger.catalog import load

registry = load()

SF = "/root/testdata/sf0.001"
EAGER = ("incremental_ingest", "process_files_ledger", "run_counters", "drop_reasons", "streamed_conform", "open_issues")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query_equals_sql(spark, con, name):
    ok, message = compare(spark, con, name, SF)
    assert ok, message


@pytest.mark.parametrize("name", [n for n in registry.QUERIES if n not in EAGER])
def test_plan_scales(spark, name):
    """No cross or nested-loop joins, no Python in the plan, no window over everything."""
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", plan)
    assert not re.search(r"EvalPython|PythonUDF|MapInPandas|FlatMapGroups", plan)
    for window in re.findall(r"Window \[(.*)\]", plan):
        assert "windowspecdefinition(" in window
        assert not re.search(r"windowspecdefinition\(\w+#\d+L? (ASC|DESC)", window)


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLES) <= set(entry.queries()) & set(entry.oracle_sql())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "principal" and df.count() > 1
