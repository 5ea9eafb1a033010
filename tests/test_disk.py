"""What the jobs keep on disk and move: landed lines, layers, scratch copies, rows of a merge."""

import random

import pytest
from pyspark.sql import functions as F
from test_merge import _arrive, _random_rows, _rows
from test_row_movement import small_tables  # noqa: F401

from orderlake.operators import dedup
from orderlake.operators.dedup import deduplicate, rows_in_files
from orderlake.plans import merge, queries
from orderlake.plans.jobs import run_transformation
from orderlake.plans.queries import REGISTRY
from orderlake.session import DROP_SHUFFLES
from orderlake.sources.parquet import read_bronze, read_silver
from orderlake.sources.sinks import write_bronze
from orderlake.sources.store import Store
from orderlake.sources.tables import bronze_from_tables

(SETTING,) = DROP_SHUFFLES


def test_malformed_lines_land_compressed(spark, small_tables, monkeypatch):  # noqa: F811
    made = []
    path = queries.scratch_path
    monkeypatch.setattr(queries, "scratch_path", lambda s, name: made.append(path(s, name)) or made[-1])
    rows = REGISTRY["csv_corrupt_records"](spark, small_tables)
    assert {f.rsplit(".", 1)[-1] for f, _ in Store(spark, made[0]).files()} == {"gz"}
    assert spark.read.text(made[0]).count() == queries.raw_orders_from_tables(spark, small_tables).count()
    assert rows.count() > 0 and rows.where("_corrupt_record IS NULL").count() == 0


def test_stored_bronze_is_not_stored_again(spark, small_tables, tmp_dir, monkeypatch):  # noqa: F811
    bronze = bronze_from_tables(spark, small_tables)
    for rows in (bronze, bronze.limit(30), bronze.limit(0)):
        write_bronze(rows, f"{tmp_dir}/bronze")
    stored, seen = [], []
    write = dedup.stored_rows
    monkeypatch.setattr(dedup, "stored_rows", lambda df, name: stored.append(df.columns) or seen.append(spark.conf.get(SETTING)) or write(df, name))
    out = run_transformation(spark, f"{tmp_dir}/bronze", f"{tmp_dir}/silver")
    assert stored and not any("product_name" in columns for columns in stored)
    # Shuffle files end with their step, and the setting with the job.
    assert set(seen) == {"true"} and spark.conf.get(SETTING) == "false"
    rows = bronze.count()
    assert out.metrics["bronze_rows"] == rows + 30 and out.records == out.metrics["bronze_rows"] - out.metrics["duplicates_removed"]
    assert sorted(r.order_id for r in read_silver(spark, f"{tmp_dir}/silver", completed_only=False).collect()) == sorted(r.order_id for r in deduplicate(bronze).collect())
    for layer in ("bronze", "silver"):
        assert all(f.endswith(".zstd.parquet") for f, _ in Store(spark, f"{tmp_dir}/{layer}").files() if not f.startswith("_"))


def test_rows_in_files_keep_their_numbers(spark, small_tables, tmp_dir, monkeypatch):  # noqa: F811
    bronze = bronze_from_tables(spark, small_tables)
    for part in (bronze, bronze.where("quantity > 2")):
        write_bronze(part, f"{tmp_dir}/a b+%20c")
    stored = read_bronze(spark, f"{tmp_dir}/a b+%20c")
    found = rows_in_files(stored)
    assert found.count == stored.count() == found.rows.select("_row").distinct().count()
    text = lambda df: sorted(map(str, df.select(*stored.columns).collect()))
    for bound in (dedup._BROADCAST_ROWS, 0):
        monkeypatch.setattr(dedup, "_BROADCAST_ROWS", bound)
        assert text(found.latest()) == text(deduplicate(stored))
        some = found.rows.where("quantity > 2").select("_row")
        assert text(found.having(some)) == text(stored.where("quantity > 2"))
        assert text(found.without(some)) == text(stored.where("NOT quantity > 2 OR quantity IS NULL"))
    assert found.paths_of(found.rows.where("false").select("_row")) == []
    assert len(found.paths_of(found.rows.select("_row"))) == found.files.count()


@pytest.mark.parametrize("grouped", [True, False])
def test_a_merge_moves_no_full_rows(spark, tmp_dir, monkeypatch, grouped):
    rng = random.Random(5)
    if not grouped:
        monkeypatch.setattr(dedup, "FOLDER_FILES", 0)
    plans = []
    write = merge.write_silver
    monkeypatch.setattr(merge, "write_silver", lambda df, path, **k: plans.append((df._jdf.queryExecution().executedPlan().toString(), k["clustered"])) or write(df, path, **k))
    for i in range(2):
        _arrive(spark, f"{tmp_dir}/bronze", f"run-{i}", _random_rows(rng, 20, 30), f"2024-01-0{i + 1} 00:00:00")
        run_transformation(spark, f"{tmp_dir}/bronze", f"{tmp_dir}/silver", incremental=True)
    ((plan, clustered),) = plans
    assert clustered == grouped
    # Bitmaps are grouped by bucket and broadcast; nothing is dealt out or sorted by order.
    assert "order_id" not in "".join(line for line in plan.splitlines() if "Exchange" in line or "Sort " in line)
    run_transformation(spark, f"{tmp_dir}/bronze", f"{tmp_dir}/whole")
    merged, whole = (read_silver(spark, f"{tmp_dir}/{s}", completed_only=False).drop("_transformed_at") for s in ("silver", "whole"))
    assert _rows(merged) == _rows(whole)


def test_silver_of_the_tables_moves_no_full_rows(spark, small_tables, monkeypatch):  # noqa: F811
    plans = []
    write = queries.write_silver
    monkeypatch.setattr(queries, "write_silver", lambda df, path, **k: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(df, path, **k))
    rows = {r.mart: r.rows for r in REGISTRY["mart_roundtrip"](spark, small_tables).collect()}
    assert "REBALANCE" not in plans[0] and rows["sales_by_region"] > 0
    assert rows["customer_segments"] == REGISTRY["rfm_base"](spark, small_tables).agg(F.count(F.lit(1))).first()[0]
