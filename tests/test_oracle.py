"""Every catalogue query against its DuckDB twin on the sf0.001 driver tables
(the driver repeats this at sf0.01). Queries without SQL are checked for rows."""

import os

import pytest

import __spark_entry__ as E
from ratecraft.plans.compare import digest, duck_connect, type_diff

SF = os.environ.get("RATECRAFT_TEST_SF", "/root/testdata/sf0.001")
QUERIES = E.queries()
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF)


def test_every_query_has_a_callable_and_sql_keys_exist():
    assert set(SQL) <= set(QUERIES)
    assert len(SQL) >= 40


def _plan(spark, df) -> str:
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("key", sorted(SQL))
def test_matches_duckdb(spark, con, key):
    df = QUERIES[key](spark, SF)
    plan = _plan(spark, df)
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(SQL[key])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert type_diff(df, con.sql(SQL[key])) == {}
    assert len(rows) == len(orows)
    h1, l1 = digest(df.columns, rows)
    h2, l2 = digest(ocols, orows)
    assert h1 == h2, (sorted(set(l1) - set(l2))[:3], sorted(set(l2) - set(l1))[:3])


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(SQL)))
def test_rows_only(spark, key):
    df = QUERIES[key](spark, SF)
    assert df.count() > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns == ["nk", "yr", "pr", "population", "a", "n", "r"]


def test_flagship_plan_prunes_and_pushes(spark):
    plan = _plan(spark, QUERIES["rate_pivot"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string>" in plan
    assert "PushedFilters: [IsNotNull(l_returnflag), IsNotNull(l_orderkey)]" in plan
