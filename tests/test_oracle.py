"""Every registered query equals its DuckDB SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from orderlake.plans.oracle import ORACLE
from orderlake.plans.queries import REGISTRY
from tests.conftest import SF_SMALL
from tools.compare_oracle import TABLES, digest, duck_types, spark_types

KEYS = sorted(REGISTRY)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_of_the_order_engine_has_sql():
    assert set(ORACLE) == set(REGISTRY)
    assert set(REGISTRY) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_sql(spark, duck, key):
    df = entry.queries()[key](spark, SF_SMALL)
    s_cols, s_hash, s_lines = digest(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(entry.oracle_sql()[key])
    d_cols, d_hash, d_lines = digest([c[0] for c in res.description], res.fetchall())
    assert s_cols == d_cols
    assert spark_types(df) == duck_types(duck.sql(entry.oracle_sql()[key]))
    assert len(s_lines) == len(d_lines)
    assert s_hash == d_hash, (sorted(set(s_lines) - set(d_lines))[:2], sorted(set(d_lines) - set(s_lines))[:2])


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "revenue_rank" in df.columns


@pytest.mark.parametrize("key", ["silver_columns", "sales_by_region", "product_performance", "customer_segments", "layer_checks"])
def test_no_python_in_plans(spark, key):
    df = entry.queries()[key](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for marker in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert marker not in plan
