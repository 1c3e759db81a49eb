"""Every registered query against its SQL on the smallest tables."""

import os

import pytest
from oracle import connect, differences

import __spark_entry__ as entry
from corpusloom import catalog

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


# queries of the optional subpackage have their tests beside them
NAMES = [name for name in entry.queries() if name in catalog.QUERIES]


def test_every_query_has_its_sql():
    assert set(NAMES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF_DIR)
    assert differences(con, df, entry.oracle_sql()[name]) == ""
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan
    assert name.startswith("u1_") or ("Python" not in plan and "Pandas" not in plan)


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.columns == ["category", "accept", "reject", "pass_rate"] and rows.count() > 0
