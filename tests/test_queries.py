"""Every registered query against its check SQL on the smallest tables."""

import pytest
from compare import differences, duck

from __spark_entry__ import entry, oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def physical_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    result = queries()[name](spark, FOLDER)
    plan = physical_plan(result)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name in oracle_sql():
        problem, _ = differences(result, con, oracle_sql()[name])
        assert problem == ""
    else:
        assert result.count() > 0


def test_entry(spark):
    result = entry(spark)
    assert result.columns == ["a", "b", "k", "score", "rank"]
    assert result.count() > 0


def test_checks_name_real_queries():
    assert set(oracle_sql()) <= set(queries())


def test_filters_and_columns_reach_the_scan(spark):
    acts = physical_plan(queries()["event_interactions"](spark, FOLDER))
    assert "In(event_type, [click,purchase,view])" in acts and "value" not in acts
    recent = physical_plan(queries()["trending"](spark, FOLDER))
    assert "GreaterThanOrEqual(o_orderdate" in recent and "o_totalprice" not in recent


def test_top_lists_are_cut_before_the_shuffle(spark):
    assert physical_plan(queries()["item_cosine"](spark, FOLDER)).count("WindowGroupLimit") == 2
