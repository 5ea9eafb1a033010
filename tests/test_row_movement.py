"""What is moved and written on the way to the layers: raw rows of the tables, bronze and silver by month."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from orderlake import schema
from orderlake.plans import jobs
from orderlake.plans.jobs import run_transformation
from orderlake.plans.queries import REGISTRY
from orderlake.plans.silver import silver_from_bronze
from orderlake.sources import tables
from orderlake.sources.parquet import read_silver
from orderlake.sources.sinks import write_bronze
from orderlake.sources.tables import raw_orders_from_tables


@pytest.fixture()
def small_tables(spark, tmp_dir):
    """Sixty orders over six months with three line items each; one order and one part twice, keys missing and without a match."""
    day = lambda i: dt.datetime(2024, 1 + i % 6, 1 + i % 28)
    made = {
        "region": ([(0, "EUROPE"), (1, "ASIA")], "r_regionkey int, r_name string"),
        "nation": ([(i, f"NATION {i}", i % 2) for i in range(4)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(i, f"Customer#{i:09d}", i % 5) for i in range(12)], "c_custkey long, c_name string, c_nationkey int"),
        "part": ([(i, f"part {i}", "electronics", 5.0 + i) for i in [*range(8), 3]], "p_partkey long, p_name string, p_type string, p_retailprice double"),
        "orders": (
            [(k, i % 12, "FOP"[i % 3], "1-URGENT", day(i)) for i, k in enumerate([*range(1, 60), 100_000_000, 5, None])],
            "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string, o_orderdate timestamp",
        ),
        "lineitem": (
            [(k, (k or 1) % 9, n, 1.0 + n, 0.05, "NR"[n % 2], day((k or 1) + n)) for k in [*range(1, 60), 100_000_000, None] for n in (1, 2, 3)],
            "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_discount double, l_returnflag string, l_shipdate timestamp",
        ),
    }
    for name, (rows, kinds) in made.items():
        spark.createDataFrame(rows, kinds).write.parquet(f"{tmp_dir}/{name}.parquet")
    return tmp_dir


def _rows(df):
    return sorted(map(str, df.collect()))


def test_numbers_are_padded_as_a_format_does(spark):
    rows = spark.createDataFrame([(n,) for n in (0, 7, 99_999_999, 100_000_000, -3, None)], "n long")
    for digits in (6, 8):
        both = rows.select(tables._numbered("ORD-", F.col("n"), digits).alias("a"), F.format_string(f"ORD-%0{digits}d", "n").alias("b"))
        assert all(r.a == r.b for r in both.collect())


def test_line_items_join_orders_last_and_by_month_gives_the_same_rows(spark, small_tables):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        raw = raw_orders_from_tables(spark, small_tables)
        plan = raw._jdf.queryExecution().executedPlan().toString()
        plain = _rows(raw)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The upper join comes first in the text.
    assert plan.index("[l_orderkey") < plan.index("[l_partkey")
    assert len(plain) > 100
    grouped = raw_orders_from_tables(spark, small_tables, by_month=True)
    assert _rows(grouped) == plain
    moved = grouped._jdf.queryExecution().executedPlan().toString().split("REBALANCE")[0]
    # Raw fields are made behind the shuffle.
    assert "REBALANCE" in grouped._jdf.queryExecution().executedPlan().toString() and "ORD-" in moved


def test_bronze_source_of_several_runs_is_made_once(spark, small_tables, monkeypatch):
    from orderlake.plans import queries

    calls = []
    made = queries.bronze_from_tables
    monkeypatch.setattr(queries, "bronze_from_tables", lambda *a, **k: calls.append(k) or made(*a, **k))
    once = _rows(REGISTRY["bronze_roundtrip"](spark, small_tables))
    calls.clear()
    assert _rows(REGISTRY["bronze_append_rerun"](spark, small_tables)) == sorted(once * 2)
    assert _rows(REGISTRY["bronze_commits"](spark, small_tables)) == once
    assert len(calls) == 2


def test_silver_of_bronze_by_month_moves_no_full_rows(spark, small_tables, tmp_dir, monkeypatch):
    bronze = tables.bronze_from_tables(spark, small_tables)
    write_bronze(bronze.unionByName(bronze.limit(20)), f"{tmp_dir}/bronze")
    assert jobs._files_by_month(spark, f"{tmp_dir}/bronze")
    stored = lambda grouped: silver_from_bronze(spark.read.schema(schema.BRONZE_SCHEMA).parquet(f"{tmp_dir}/bronze"), stored=True, grouped=grouped)._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE" in stored(False) and "REBALANCE" not in stored(True)
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    found = {}
    for files in (4, 0):
        monkeypatch.setattr(jobs, "MONTH_FILES", files)
        assert jobs._files_by_month(spark, f"{tmp_dir}/bronze") == bool(files)
        out = run_transformation(spark, f"{tmp_dir}/bronze", f"{tmp_dir}/silver-{files}")
        found[files] = (out, _rows(read_silver(spark, f"{tmp_dir}/silver-{files}", completed_only=False).drop("_transformed_at")))
    assert found[4] == found[0] and found[4][0].metrics["duplicates_removed"] >= 20
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == split
