"""Every registered query against its SQL twin."""

import pytest

import __spark_entry__ as entry_point
from compare import differences, duck
from daymend.queries.oracles import ORACLES
from daymend.queries.registry import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLES) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    frame = entry_point.queries()[name](spark, SF)
    assert differences(frame, con, entry_point.oracle_sql()[name]) == ""
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not [bad for bad in ("CartesianProduct", "NestedLoopJoin", "Python") if bad in plan]


def test_sample_is_a_top_k(spark):
    plan = entry_point.queries()["model_sample"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_mart_reads_three_columns(spark):
    frame = entry_point.queries()["backfill_partial_mart"](spark, SF)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<gross_amount:decimal(10,2),tax_amount:decimal(10,2),net_amount:decimal(11,2)>" in plan


def test_entry(spark):
    frame = entry_point.entry(spark)
    assert frame.columns == ["sale_date", "orders", "gross_total", "tax_total", "net_total"]
    assert frame.count() == 30


def test_shared_state_is_rebuilt_when_it_lost_rows(spark):
    from daymend.operators.write import clear_table
    from daymend.plans.flow import FACT
    from daymend.queries.fixtures import mid_bug, shared
    first = shared(mid_bug, spark, SF)
    assert shared(mid_bug, spark, SF) is first
    clear_table(first.store, FACT)
    assert shared(mid_bug, spark, SF) is not first
