"""Appends under a run key: killed at any moment and repeated, each row is there once, and readers see whole runs."""

import json
import os
import threading

import pytest
from pyspark.sql import functions as F

from orderlake import schema
from orderlake.operators.dedup import deduplicate
from orderlake.plans.jobs import run_ingestion
from orderlake.plans.pipeline import LayerPaths, run_pipeline
from orderlake.sources import commits
from orderlake.sources.csv import write_raw_csv
from orderlake.sources.parquet import read_bronze, read_quarantine, read_silver
from orderlake.sources.sinks import write_bronze
from orderlake.sources.store import Store
from orderlake.streaming.ingest import ingest_new_files
from tests.conftest import order, raw_frame


class Killed(Exception):
    pass


class Strike:
    """Raises at the n-th change of the store, before or after it is made."""

    def __init__(self, monkeypatch, at, after):
        self.left, self.struck, self.lock = at, False, threading.Lock()
        for name in ("move", "write_text", "delete"):
            monkeypatch.setattr(Store, name, self._wrap(getattr(Store, name), after))

    def _wrap(self, change, after):
        def run(store, *args):
            with self.lock:  # files are moved side by side
                self.left -= 1
                mine = self.left == 0
                self.struck |= mine
                gone = self.left < 0 and self.struck
            if gone and not after:
                raise Killed  # the process that made the other change is dead, too
            if mine and not after:
                raise Killed
            out = change(store, *args)
            if mine:
                raise Killed
            return out

        return run


def _rows(frame):
    return sorted(r.order_id for r in frame.select("order_id").collect())


def _months(spark, n=4):
    rows = [order(order_id=f"ORD-{i}", order_year=2024, order_month=1 + i % n, order_day=1) for i in range(12)]
    return raw_frame(spark, rows)


@pytest.fixture()
def bronze_rows(spark):
    from orderlake.operators.metadata import add_ingestion_metadata

    return add_ingestion_metadata(_months(spark), "s", "2024-01-01 00:00:00")


@pytest.mark.parametrize("after", [False, True])
def test_a_run_killed_at_any_change_is_there_once(spark, tmp_dir, bronze_rows, after):
    at, strikes = 1, 0
    while True:
        root = f"{tmp_dir}/bronze {after} {at}"
        with pytest.MonkeyPatch.context() as patch:
            strike = Strike(patch, at, after)
            try:
                write_bronze(bronze_rows, root, run_key="r1")
            except Killed:
                strikes += 1
                # Readers see the run whole or not at all.
                if os.path.isdir(root):
                    assert read_bronze(spark, root).count() in (0, 12)
        assert write_bronze(bronze_rows, root, run_key="r1") == 12
        assert _rows(read_bronze(spark, root)) == sorted(f"ORD-{i}" for i in range(12))
        assert Store(spark, root).names(commits.OPEN) == []
        if not strike.struck:
            break
        at += 1
    assert strikes >= 7  # manifest, four moves, marker, two deletions


def test_killed_while_staging(spark, tmp_dir, bronze_rows):
    root = f"{tmp_dir}/b"

    def stage(path):
        write_bronze(bronze_rows, path, "overwrite")
        raise Killed

    with pytest.raises(Killed):
        commits.append_once(spark, root, "r1", stage)
    assert write_bronze(bronze_rows, root, run_key="r1") == 12
    assert read_bronze(spark, root).count() == 12
    assert not os.path.exists(f"{root}/_staging/r1")


def test_repeated_runs_read_nothing_and_other_keys_append(spark, tmp_dir, bronze_rows):
    root = f"{tmp_dir}/b"
    write_bronze(bronze_rows, root, run_key="r1")

    def never(path):
        raise AssertionError("staged again")

    assert commits.append_once(spark, root, "r1", never) == {"rows": 12}
    assert write_bronze(bronze_rows, root) == 12 and write_bronze(bronze_rows, root, run_key="r2") == 12
    assert read_bronze(spark, root).count() == 36 and deduplicate(read_bronze(spark, root)).count() == 12
    # Other readers of the folder see the same rows and the plain partition layout.
    plain = spark.read.parquet(root)
    assert plain.count() == 36 and set(plain.columns) == set(schema.BRONZE_COLUMNS)
    assert write_bronze(bronze_rows.limit(0), f"{tmp_dir}/none", run_key="r1") == 0


def test_open_runs_are_hidden_and_recovered(spark, tmp_dir, bronze_rows, monkeypatch):
    root = f"{tmp_dir}/b"
    write_bronze(bronze_rows, root, run_key="r1")
    moves = []

    def second_fails(store, source, target):
        moves.append(target)
        if len(moves) == 2:
            raise Killed
        return move(store, source, target)

    move = Store.move
    monkeypatch.setattr(Store, "move", second_fails)
    with pytest.raises(Killed):
        write_bronze(bronze_rows, root, run_key="r10")
    monkeypatch.setattr(Store, "move", move)
    assert spark.read.parquet(root).count() > 12 == read_bronze(spark, root).count()
    assert commits.committed(spark, root, "r10") is None
    os.makedirs(f"{root}/_staging/dead/x")
    assert commits.recover(spark, root, discard_staged=True) == ["r10"]
    assert read_bronze(spark, root).count() == 24 and not os.path.exists(f"{root}/_staging")
    assert commits.committed(spark, root, "r10") == {"rows": 12}


def test_a_lost_file_is_an_error(spark, tmp_dir, bronze_rows, monkeypatch):
    root = f"{tmp_dir}/b"
    monkeypatch.setattr(commits, "_publish", lambda store, key: (_ for _ in ()).throw(Killed()))
    with pytest.raises(Killed):
        write_bronze(bronze_rows, root, run_key="r1")
    monkeypatch.undo()
    Store(spark, root).delete("_staging")
    with pytest.raises(FileNotFoundError, match="r1 lost"):
        write_bronze(bronze_rows, root, run_key="r1")


def test_unfit_keys_are_refused(spark, tmp_dir):
    for key in ("", "a/b", "../x", "_hidden", "a b"):
        with pytest.raises(ValueError):
            commits.append_once(spark, tmp_dir, key, dict)


@pytest.mark.parametrize("after", [1, 2, 4, 6])
def test_a_killed_stream_batch_is_repeated_without_doubling(spark, tmp_dir, after):
    landing, bronze, ckpt = f"{tmp_dir}/land ing", f"{tmp_dir}/bro nze %41", f"{tmp_dir}/ck pt"
    write_raw_csv(_months(spark), f"{landing}/a")
    with pytest.MonkeyPatch.context() as patch:
        Strike(patch, after, True)
        with pytest.raises(Exception):
            ingest_new_files(spark, f"{landing}/*", bronze, ckpt)
    assert ingest_new_files(spark, f"{landing}/*", bronze, ckpt) == 12
    assert ingest_new_files(spark, f"{landing}/*", bronze, ckpt) == 0
    assert _rows(read_bronze(spark, bronze)) == sorted(f"ORD-{i}" for i in range(12))
    # A batch job may append to the same folder, and both kinds of rows are read.
    assert run_ingestion(spark, f"{landing}/*/*.csv", bronze).records == 12
    runs = read_bronze(spark, bronze).groupBy("_pipeline_run_id").count().collect()
    assert sorted(r["count"] for r in runs) == [12, 12]


def _landing(spark, path):
    rows = [order(order_id=f"ORD-{i}") for i in range(5)] + [order(order_id=None), order(customer_id=None, product_id=None, order_id="ORD-X")]
    write_raw_csv(raw_frame(spark, rows), path)
    with open(f"{path}/bad.csv", "w") as f:
        f.write(",".join(schema.RAW_COLUMNS) + "\nORD-SHORT,C-1\nORD-Q,C-1" + "," * 9 + "many" + "," * 12 + "\n")


def test_quarantine_is_split_off_in_one_read(spark, tmp_dir, monkeypatch):
    _landing(spark, f"{tmp_dir}/l")
    reads = []
    from orderlake.plans import jobs

    original = jobs.read_raw_csv
    monkeypatch.setattr(jobs, "read_raw_csv", lambda *a, **k: reads.append(a) or original(*a, **k))
    bronze, bad = f"{tmp_dir}/b", f"{tmp_dir}/q"
    out = [run_ingestion(spark, f"{tmp_dir}/l/*.csv", bronze, "2024-01-01 00:00:00", quarantine_path=bad, run_key="day-1") for _ in range(2)]
    assert out[0] == out[1] and out[0].records == 5
    assert out[0].metrics == {"quarantined_rows": 4, "read_rows": 9, "corrupt_rows": 2, "invalid_rows": 4}
    assert len(reads) == 2
    assert _rows(read_bronze(spark, bronze)) == [f"ORD-{i}" for i in range(5)]
    got = {(r.order_id, tuple(r._quarantine_reasons), r._corrupt_record is not None, r._pipeline_run_id) for r in read_quarantine(spark, bad).collect()}
    run = "2024-01-01T000000"
    assert got == {
        (None, ("order_id is null",), False, run),
        ("ORD-X", ("customer_id is null", "product_id is null"), False, run),
        ("ORD-SHORT", ("product_id is null",), True, run),
        ("ORD-Q", ("product_id is null",), True, run),
    }
    # Rows of later runs, with or without a quarantine, are read together.
    run_ingestion(spark, f"{tmp_dir}/l/*.csv", bronze, "2024-01-02 00:00:00")
    assert read_bronze(spark, bronze).count() == 10 and read_quarantine(spark, bad).count() == 4


def test_a_killed_split_reaches_both_tables_or_neither(spark, tmp_dir):
    _landing(spark, f"{tmp_dir}/l")
    for at in (1, 2, 3, 4, 5, 6):
        bronze, bad = f"{tmp_dir}/b{at}", f"{tmp_dir}/q{at}"
        job = lambda: run_ingestion(spark, f"{tmp_dir}/l/*.csv", bronze, "2024-01-01 00:00:00", quarantine_path=bad, run_key="k")  # noqa: B023, E731
        with pytest.MonkeyPatch.context() as patch:
            Strike(patch, at, True)
            with pytest.raises(Killed):
                job()
        assert job().metrics["quarantined_rows"] == 4
        assert read_bronze(spark, bronze).count() == 5 and read_quarantine(spark, bad).count() == 4


def _modified(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names}


@pytest.mark.parametrize("broken", ["transformation", "load"])
def test_a_run_is_taken_up_where_it_broke_off(spark, tmp_dir, monkeypatch, broken):
    from orderlake.plans import pipeline

    _landing(spark, f"{tmp_dir}/l")
    paths = LayerPaths(f"{tmp_dir}/l/*.csv", f"{tmp_dir}/b", f"{tmp_dir}/s", f"{tmp_dir}/g", f"{tmp_dir}/q")
    go = lambda key="run-1": run_pipeline(spark, None, paths, "2024-01-01 00:00:00", journal=f"{tmp_dir}/j", run_key=key)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(pipeline, f"run_{broken}", lambda *a: (_ for _ in ()).throw(Killed()))
        with pytest.raises(Killed):
            go()
    before = {layer: _modified(f"{tmp_dir}/{layer}") for layer in "bsq"}
    out = go()
    done = pipeline.ALL_STEPS.index(broken)
    assert [out[s]["resumed"] for s in pipeline.ALL_STEPS] == [True] * done + [False] * (3 - done)
    assert out["ingestion"]["records"] == 5 and out["ingestion"]["metrics"]["quarantined_rows"] == 4 and out["transformation"]["records"] == 5
    after = {layer: _modified(f"{tmp_dir}/{layer}") for layer in "bsq"}
    assert after["b"] == before["b"] and after["q"] == before["q"] and (broken != "load" or after["s"] == before["s"])
    again = go()
    assert all(again[s]["resumed"] for s in pipeline.ALL_STEPS) and {k: v["records"] for k, v in again.items()} == {k: v["records"] for k, v in out.items()}
    # New raw files are a new input of a new run.
    write_raw_csv(raw_frame(spark, [order(order_id="NEW")]), f"{tmp_dir}/l2")
    more = LayerPaths(f"{tmp_dir}/l2/*.csv", *list(vars(paths).values())[1:])
    new = run_pipeline(spark, None, more, "2024-01-02 00:00:00", journal=f"{tmp_dir}/j", run_key="run-2")
    assert not any(new[s]["resumed"] for s in pipeline.ALL_STEPS) and new["transformation"]["records"] == 6
    assert read_silver(spark, f"{tmp_dir}/s", completed_only=False).where(F.col("order_id") == "NEW").count() == 1
    with pytest.raises(ValueError, match="run_key"):
        run_pipeline(spark, None, paths, journal=f"{tmp_dir}/j")


def test_manifests_name_whole_files(spark, tmp_dir, bronze_rows, monkeypatch):
    root = f"{tmp_dir}/b"
    monkeypatch.setattr(commits, "_publish", lambda store, key: json.loads(store.read_text(f"{commits.OPEN}/{key}").splitlines()[0])["counts"])
    assert write_bronze(bronze_rows, root, run_key="r1") == 12
    head, *lines = Store(spark, root).read_text(f"{commits.OPEN}/r1").splitlines()
    assert len(lines) == 4 and all(json.loads(x)[1].startswith("order_year=2024/order_month=") for x in lines)
    assert all("/r1+part-" in json.loads(x)[1] for x in lines)
