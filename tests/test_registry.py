"""Every registered query against its SQL, on the smallest supplied tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry_module
from workload.compare import connect, rows_of
from workload.oracles import ORACLES
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="supplied tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLES:
        assert got
        return
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert got == rows_of(columns, cursor.fetchall())


def test_contract(spark):
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
    assert len(entry_module.entry(spark).columns) == 3


def test_plans_have_no_nested_loops_over_tables(spark):
    """Scalar subqueries aside, no query pairs rows without an equality."""
    for name, query in QUERIES.items():
        plan = query(spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
