"""Top-k in three phases: brute force over odd tables, and what clustered vectors let it leave out."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orderlake.llm import topk


def _brute(rows, every, k, scale=1024):
    used = [(i, np.floor(scale * np.array(v, np.float64))) for i, v, *_ in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = {}
    for q, a in used:
        if q % every:
            continue
        for i, b in used:
            if i != q:
                d = min(len(a), len(b))
                s = sum(int(x) * int(y) for x, y in zip(a[:d], b[:d]))
                out.setdefault(q, {})[i] = max(s, out.get(q, {}).get(i, s))
    return sorted((q, r, i, s) for q, best in out.items() for r, (s, i) in enumerate(sorted(((s, i) for i, s in best.items()), key=lambda x: (-x[0], x[1]))[:k], 1))


@pytest.mark.parametrize("block, together, group", [(1024, 16, 1024), (16, 4, 3), (7, 1, 1)])
def test_results_equal_brute_force(spark, monkeypatch, block, together, group):
    for name, value in (("BLOCK", block), ("TOGETHER", together), ("GROUP", group)):
        monkeypatch.setattr(topk, name, value)
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=12) + 3 * (i % 5)).round(3).tolist(), "x") for i in range(260)] + [(300 + i, [0.5] * 12, "x") for i in range(40)]
    rows += [rows[1], rows[20], (20, rows[33][1], "y"), (20, rows[34][1], "y"), (7, rows[3][1], "y")]  # repeated rows, ids with several vectors
    rows += [(501, None, ""), (510, [1.0, None] * 6, ""), (520, [float("nan")] * 12, ""), (None, [1.0] * 12, ""), (530, [], ""), (531, [2.0], ""), (540, [9.0] * 14, ""), (550, [0.0] * 12, "")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string").repartition(4)
    got = sorted(map(tuple, topk.top_k(frame, F.col("vec_id") % 10 == 0, 6).collect()))
    assert got == _brute(rows, 10, 6)
    few = frame.where("vec_id IN (0, 1, 530)")
    assert sorted(map(tuple, topk.top_k(few, F.col("vec_id") % 10 == 0, 6).collect())) == _brute([r for r in rows if r[0] in (0, 1, 530)], 10, 6)
    assert topk.top_k(frame.limit(0), F.col("vec_id") % 10 == 0).count() == 0 and topk.top_k(frame, F.lit(False)).count() == 0


def test_big_numbers_are_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.integers(-9000, 9000, 6) * 100.0).tolist(), "") for i in range(80)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    got = sorted(map(tuple, topk.top_k(frame, F.col("vec_id") % 8 == 0, 5).collect()))
    assert got == _brute(rows, 8, 5) and max(r[3] for r in got) > 1 << 53


def test_the_last_phase_reads_few_blocks_of_clustered_vectors():
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(40, 32))
    x = (centers[rng.integers(0, 40, 16_000)] + 0.1 * rng.normal(size=(16_000, 32))).tolist()
    batch = pa.RecordBatch.from_arrays([pa.array(range(16_000)), pa.array(x)], names=["id", "vector"])
    blocks = [topk.Block(*(part[f.name][0].as_py() for f in topk._PACKED)) for part in topk._pack(1024, 256, 64)(iter([batch]))]
    assert sum(len(b.ids) for b in blocks) == 16_000 and max(len(b.ids) for b in blocks) <= 256
    m = np.floor(1024 * np.array(x))
    asked = list(range(0, 16_000, 400))
    queries = topk.Queries(np.array(asked), [m[i] for i in asked])
    cuts = {}
    for i in asked:
        score = m @ m[i]
        score[i] = -np.inf
        cuts[i] = int(np.sort(score)[-10])
    queries.cuts = cuts
    read = entries = 0
    for block in blocks:
        q = queries.fitted(block.dim)
        upper = topk.bounds(q, block)
        for k, (a, b) in enumerate(topk.cuts_of(block.dim)):
            assert (block.x[:, a:b] @ q[:, a:b].T <= upper[:, k]).all()
        left = topk.surviving(queries, upper)
        read += len(left)
        for j in left:
            score, ids = topk.resolve(q[j], asked[j], cuts[asked[j]], upper[j], block)
            entries += len(ids)
    # Every result is there, from a few of the blocks.
    assert entries >= 10 * len(asked) and read < 0.15 * len(blocks) * len(asked)


def test_plans_move_vectors_at_most_once(spark):
    rng = np.random.default_rng(6)
    frame = spark.createDataFrame([(i, rng.normal(size=8).tolist()) for i in range(300)], "vec_id long, embedding array<double>")
    rows = frame.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    packed = rows.mapInArrow(topk._pack(1024, 64, 4), topk._PACKED_DDL)
    assert "Exchange" not in packed._jdf.queryExecution().executedPlan().toString()
