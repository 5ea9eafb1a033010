"""Silver merged run by run equals silver rebuilt from all of bronze, and only touched files are written."""

import os
import random

import pytest

from orderlake import schema
from orderlake.operators.metadata import add_ingestion_metadata
from orderlake.plans.jobs import run_transformation
from orderlake.plans.merge import merge_new_runs, merged_runs
from orderlake.plans.silver import silver_from_bronze
from orderlake.sources import commits
from orderlake.sources.parquet import read_bronze, read_silver
from orderlake.sources.sinks import write_bronze
from orderlake.sources.store import Store
from tests.conftest import order, raw_frame
from tests.test_commits import Killed, Strike

CATEGORIES = ["Books", "books ", "Home & Garden", "Toys/50%", None]


def _arrive(spark, root, run, rows, at):
    write_bronze(add_ingestion_metadata(raw_frame(spark, rows), "s", at), root, run_key=run)


def _random_rows(rng, ids, n):
    out = []
    for _ in range(n):
        month = rng.choice([1, 2, 3, None])
        out.append(order(order_id=f"O{rng.randrange(ids)}", order_month=month, order_date=f"2024-0{month or 1}-10 10:00:00", category=rng.choice(CATEGORIES),
                         quantity=rng.choice([1, 2, 500]), status=rng.choice(["completed", " Pending", "odd"]), created_at=rng.choice(["2024-01-01 00:00:00", "2024-01-02 00:00:00", None])))
    return out


def _rows(df):
    return sorted(map(repr, df.select(*[c for c in schema.SILVER_COLUMNS if c != "_transformed_at"]).collect()))


def _files(root):
    return {os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_merged_silver_equals_a_full_rebuild(spark, tmp_dir, seed):
    rng = random.Random(seed)
    bronze, silver = f"{tmp_dir}/bro nze", f"{tmp_dir}/sil ver"
    # Runs of one time tie with each other; late runs arrive before earlier ones.
    times = ["2024-05-01 00:00:00", "2024-05-02 00:00:00", "2024-05-02 00:00:00", "2024-04-01 00:00:00", None]
    for i, at in enumerate(times):
        rows = _random_rows(rng, 60, 50)
        frame = add_ingestion_metadata(raw_frame(spark, rows), "s", at or "2024-05-03 00:00:00")
        if at is None:
            from pyspark.sql import functions as F

            frame = frame.withColumn("_ingested_at", F.lit(None).cast("timestamp"))
        write_bronze(frame, bronze, run_key=f"run-{i}")
        out = run_transformation(spark, bronze, silver, incremental=True)
        if i:
            assert out.metrics["merged_runs"] == 1 and out.metrics["new_rows"] == 50
        assert _rows(read_silver(spark, silver, completed_only=False)) == _rows(silver_from_bronze(read_bronze(spark, bronze)))
        assert merged_runs(spark, silver) == {f"run-{k}" for k in range(i + 1)}
    assert merge_new_runs(spark, bronze, silver)["written"] == 0


def test_only_touched_files_are_written(spark, tmp_dir):
    bronze, silver = f"{tmp_dir}/b", f"{tmp_dir}/s"
    rows = [order(order_id=f"O{m}{k}", order_month=m, order_date=f"2024-0{m}-05 00:00:00") for m in (1, 2, 3, 4) for k in range(3)]
    _arrive(spark, bronze, "one", rows, "2024-05-01 00:00:00")
    run_transformation(spark, bronze, silver)
    before = _files(silver)
    # An order of February moves to June, a new one comes in March, a copy of one of April came too early to matter.
    moved = [order(order_id="O21", order_month=6, order_date="2024-06-01 00:00:00"), order(order_id="new", order_month=3, order_date="2024-03-09 00:00:00")]
    _arrive(spark, bronze, "two", moved, "2024-05-02 00:00:00")
    _arrive(spark, bronze, "late", [order(order_id="O42", order_month=5, order_date="2024-05-05 00:00:00")], "2024-01-01 00:00:00")
    out = run_transformation(spark, bronze, silver, incremental=True)
    after = _files(silver)
    assert {f.split("order_month=")[1][0] for f in before - after} == {"2"}
    assert {f.split("order_month=")[1][0] for f in after - before} == {"2", "3", "6"}
    assert out.records == 4 and out.metrics["replaced_files"] == 1 and out.metrics["orders"] == 3
    got = {r.order_id: r.order_month for r in read_silver(spark, silver, completed_only=False).collect()}
    assert got["O21"] == 6 and got["new"] == 3 and got["O42"] == 4 and len(got) == 13
    assert _rows(read_silver(spark, silver, completed_only=False)) == _rows(silver_from_bronze(read_bronze(spark, bronze)))


def test_a_killed_merge_is_whole_or_absent(spark, tmp_dir):
    rows = [order(order_id=f"O{m}{k}", order_month=m, order_date=f"2024-0{m}-05 00:00:00") for m in (1, 2) for k in range(2)]
    late = [order(order_id="O10", order_month=3, order_date="2024-03-05 00:00:00"), order(order_id="O21", quantity=9, order_month=2)]
    at = 1
    while True:
        bronze, silver = f"{tmp_dir}/b{at}", f"{tmp_dir}/s{at}"
        _arrive(spark, bronze, "one", rows, "2024-05-01 00:00:00")
        run_transformation(spark, bronze, silver)
        old = _rows(read_silver(spark, silver, completed_only=False))
        _arrive(spark, bronze, "two", late, "2024-05-02 00:00:00")
        new = _rows(silver_from_bronze(read_bronze(spark, bronze)))
        with pytest.MonkeyPatch.context() as patch:
            strike = Strike(patch, at, True)
            try:
                merge_new_runs(spark, bronze, silver)
            except Killed:
                assert _rows(read_silver(spark, silver, completed_only=False)) in (old, new)
        merge_new_runs(spark, bronze, silver)
        assert _rows(read_silver(spark, silver, completed_only=False)) == new
        assert merged_runs(spark, silver) == {"one", "two"}
        if not strike.struck:
            break
        at += 2
    assert at >= 9


def test_replaced_rows_are_hidden_while_files_are_deleted(spark, tmp_dir):
    bronze, silver = f"{tmp_dir}/b", f"{tmp_dir}/s"
    _arrive(spark, bronze, "one", [order(order_id="A"), order(order_id="B")], "2024-05-01 00:00:00")
    run_transformation(spark, bronze, silver)
    _arrive(spark, bronze, "two", [order(order_id="A", quantity=9)], "2024-05-02 00:00:00")
    # Killed with the list of replaced files written and none of them deleted.
    with pytest.MonkeyPatch.context() as patch:
        original = Store.delete
        patch.setattr(Store, "delete", lambda self, name: (_ for _ in ()).throw(Killed()) if name.endswith(".parquet") else original(self, name))
        with pytest.raises(Killed):
            merge_new_runs(spark, bronze, silver)
    assert spark.read.parquet(silver).count() == 4
    assert {r.order_id: r.quantity for r in read_silver(spark, silver, completed_only=False).collect()} == {"A": 9, "B": 2}
    assert commits.recover(spark, silver) != []
    assert spark.read.parquet(silver).count() == 2


def test_a_merge_without_an_earlier_silver_is_a_full_run(spark, tmp_dir):
    bronze, silver = f"{tmp_dir}/b", f"{tmp_dir}/s"
    _arrive(spark, bronze, "one", [order(order_id="A"), order(order_id="A")], "2024-05-01 00:00:00")
    out = run_transformation(spark, bronze, silver, incremental=True)
    assert out.records == 1 and out.metrics == {"bronze_rows": 2, "duplicates_removed": 1}
    _arrive(spark, bronze, "none", [], "2024-05-01 00:00:00")
    assert run_transformation(spark, bronze, silver, incremental=True).records == 0
    # A full run takes all runs on record again.
    _arrive(spark, bronze, "two", [order(order_id="B")], "2024-05-01 00:00:00")
    run_transformation(spark, bronze, silver)
    assert merged_runs(spark, silver) == {"one", "none", "two"}
