import pytest

import __spark_entry__ as contract
from checks.compare import compare
from checks.oracle import ORACLE
from checks.queries import registry
from tests.conftest import SF_DIR


def test_every_query_has_sql():
    assert registry().keys() == ORACLE.keys()


@pytest.mark.parametrize("name", list(ORACLE))
def test_equals_sql(spark, duck, name):
    assert compare(spark, duck, SF_DIR, name) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_base_plan(spark):
    """One scan, one shuffle on the full key and one by user; inactive users go before the rules are joined."""
    df = contract.queries()["active_total"](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.index("BroadcastHashJoin") < plan.index("user_last_day")
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF"):
        assert operator not in plan
    assert "l_extendedprice" not in plan
