"""Every registered query with SQL, run on both engines; no plan may pair whole tables."""

import oracle
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert oracle.compare(df, con, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs_without_sql(spark, name):
    assert QUERIES[name](spark, FOLDER).columns


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["genre", "films", "avg_rating", "total_revenue"] and df.count() > 0
