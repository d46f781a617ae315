"""Every registered query against its SQL counterpart on the smallest input."""

import pytest

import __spark_entry__ as entry
from medloom.plans.catalog import CATALOG
from tests.compare import connect, mismatch

SF = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


# What no query may need: pairs of everything, or rows passed through Python.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas")


@pytest.mark.parametrize("name", list(CATALOG))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert [u for u in UNWANTED if u in plan] == []
    # A window over everything: only on a page of at most 1000 rows.
    assert "windowspecdefinition(specifiedwindowframe" not in plan
    assert mismatch(df, con, SQL[name]) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "observation_id"
    assert df.count() > 0
