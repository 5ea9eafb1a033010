"""Hard negatives against brute force: ties, nulls, odd lengths, big numbers, several groups of anchors."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlake.llm import hard_negatives as H

DDL = "vec_id long, embedding array<double>, label int, rank int, score string"


def brute_force(rows, every, positives, negatives, scale=256, low=30, high=90):
    used = []
    for key, v, label, *_ in rows:
        if key is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            used.append((key, label, [math.floor(scale * x) for x in v]))
    anchors = {}
    for key, label, v in used:
        if key % every == 0:
            anchors.setdefault(key, []).append((label, np.array(v, np.float64).tobytes(), v))
    out = []
    for key, same in anchors.items():
        label, _, a = min(same)
        scored = sorted((-sum(x * y for x, y in zip(a, v)), k, n) for k, n, v in used if k != key and len(v) == len(a))
        for p, pid, _ in [s for s in scored if s[2] == label][:positives]:
            picked = [s for s in scored if s[2] != label and low * -p <= 100 * -s[0] <= high * -p][:negatives]
            out += [(key, pid, i, s[1], -p, -s[0]) for i, s in enumerate(picked, 1)]
    return sorted(out)


def _clustered(rng, n, dim, labels=4):
    centers = rng.normal(size=(labels, dim))
    decay = 1 / (1 + np.arange(dim))
    return [(i, ((centers[i % labels] * 0.6 + rng.normal(size=dim)) * decay).round(2).tolist(), int(i % labels), 1, "x") for i in range(n)]


@pytest.mark.parametrize("block, group", [(4096, 2048), (37, 3)])
def test_negatives_equal_brute_force(spark, monkeypatch, block, group):
    monkeypatch.setattr(H, "BLOCK", block)
    monkeypatch.setattr(H, "GROUP", group)
    rng = np.random.default_rng(4)
    rows = _clustered(rng, 260, 20)
    rows += [(1000 + i, rows[3][1], i % 2, 1, "x") for i in range(40)]  # one vector very often
    rows += [rows[5], rows[7], (0, rows[9][1], 3, 0, "y"), (0, rows[9][1], 2, 0, "y")]  # repeated rows, ids with several rows
    rows += [(2000, None, 1, 0, ""), (2010, [1.0, None] * 10, 1, 0, ""), (2020, [math.nan] * 20, 1, 0, ""), (2030, [math.inf] * 20, 1, 0, ""),
             (2040, [1.0] * 20, None, 0, ""), (None, [1.0] * 20, 1, 0, ""), (2050, [], 1, 0, ""), (2060, [], 2, 0, ""), (2070, [3.0], 1, 0, ""), (2081, [2.0], 1, 0, ""),
             (2082, [1.0], 2, 0, ""), (2090, [0.0] * 20, 1, 0, "")]
    random.Random(1).shuffle(rows)
    frame = spark.createDataFrame(rows, DDL).repartition(3)
    got = sorted(map(tuple, H.mine(frame, F.col("vec_id") % 10 == 0, 5, 10).collect()))
    want = brute_force(rows, 10, 5, 10)
    assert got == want and len(want) > 500
    assert H.mine(frame.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert H.mine(frame, F.lit(None).cast("boolean")).count() == 0


def test_big_numbers_are_exact(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.integers(1, 9000, 6) * 400.0).tolist(), i % 2, 0, "") for i in range(60)]
    got = sorted(map(tuple, H.mine(spark.createDataFrame(rows, DDL), F.col("vec_id") % 6 == 0, 3, 4).collect()))
    want = brute_force(rows, 6, 3, 4)
    assert got == want and max(r[4] for r in want) > 1 << 53


def test_scans_leave_out_what_cannot_matter():
    rng = np.random.default_rng(5)
    rows = _clustered(rng, 4000, 64)
    data = np.ascontiguousarray(np.floor(256 * np.array([r[1] for r in rows])).T)
    block = H.Block(64, np.arange(4000).tobytes(), np.array([r[2] for r in rows]).tobytes(), data.tobytes())
    read = 0
    for i in range(0, 200, 10):
        anchor = np.ascontiguousarray(data[:, i])
        order = np.argsort(-np.abs(anchor), kind="stable")
        mine = np.flatnonzero((block.labels == block.labels[i]) & (block.ids != i))
        best = H.Best(5)
        read += H.vertical_scan(anchor, order, block, mine, [best])
        score = anchor @ data[:, mine]
        top = np.lexsort((mine, -score))[:5]
        assert best.ids == mine[top].tolist() and best.scores == score[top].tolist()
        total = 64 * len(mine)
    assert read < 0.6 * 20 * total


def test_wrong_sizes_are_refused(spark):
    with pytest.raises(ValueError):
        H.mine(spark.createDataFrame([], DDL), F.lit(True), 0, 10)
