"""Hard negatives by vertical scans of columnar blocks (the BOND way of reading vectors).

The vectors are stored once in blocks, dimension after dimension, with the least and the greatest value of
each dimension. Anchors are numbered and broadcast in groups of bounded size; the blocks stay where they are.
For an anchor, a task reads a block's dimensions by falling magnitude of the anchor's components and adds up what they
contribute. The least and greatest contributions that the unread dimensions can still make bound every
score from both sides. A candidate whose bounds miss all wanted windows of scores, or lie below the k-th
best score that is already certain, leaves the bitmap; what is left after the last dimension has its exact score.

The scan runs twice for a group: over rows of the anchor's label, in one window without ends, for the
positives; then over the other rows, with a window for each positive, for the negatives. Tasks carry their best rows from
block to block and send only these on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlake.llm._arrays import tidy
from orderlake.operators.ranking import with_global_position
from orderlake.session import scratch_path

#: Vectors in a block, anchors in a broadcast group, dimensions read between two looks at the bounds.
BLOCK = 4096
GROUP = 2048
STEP = 8
#: Up to here sums of doubles are exact; beyond, Python's integers are used.
_EXACT = 1 << 53
_LONG = (1 << 63) - 1

_BLOCKS = pa.schema([("dim", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary()), ("data", pa.binary())])
_FOUND = pa.schema([("anchor_id", pa.int64()), ("slot", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
_FOUND_DDL = "anchor_id long, slot long, vec_id long, score long"
_RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def scaled(vector: pa.Scalar, scale: int) -> np.ndarray | None:
    """floor(scale * x) of each component; None if the vector takes no part."""
    if not vector.is_valid or vector.values is None or vector.values.null_count:
        return None
    x = np.floor(scale * vector.values.to_numpy(zero_copy_only=False).astype(np.float64))
    return x if np.isfinite(x).all() else None


def _columnar(scale: int, size: int):
    """Blocks of vectors of one length, dimension after dimension."""

    def apply(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[int, int, np.ndarray]]] = {}

        def block(dim: int) -> pa.RecordBatch:
            ids, labels, rows = zip(*held.pop(dim))
            cells = (np.array(ids, np.int64), np.array(labels, np.int64), np.ascontiguousarray(np.stack(rows).T))
            return pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in cells)], schema=_BLOCKS)

        for part in parts:
            for key, label, vector in zip(part["id"].to_pylist(), part["label"].to_pylist(), part["vector"]):
                x = scaled(vector, scale)
                if x is not None:
                    rows = held.setdefault(len(x), [])
                    rows.append((key, label, x))
                    if len(rows) == size:
                        yield block(len(x))
        for dim in list(held):
            yield block(dim)

    return tidy(apply)


def _single(scale: int):
    """Anchors as rows of scaled vectors."""

    def apply(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = [(k, n, scaled(v, scale)) for k, n, v in zip(part["id"].to_pylist(), part["label"].to_pylist(), part["vector"])]
            rows = [(k, n, x.tobytes()) for k, n, x in rows if x is not None]
            ids, labels, data = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(labels, pa.int64()), pa.array(data, pa.binary())], names=["id", "label", "data"])

    return tidy(apply)


def _integers(x: np.ndarray) -> np.ndarray:
    """Doubles that hold integers as Python's integers."""
    return np.array([int(v) for v in x.ravel()], object).reshape(x.shape)


@dataclass
class Best:
    """The k best rows of one window of scores: score descending, then id."""

    k: int
    low: float | int | None = None
    high: float | int | None = None
    scores: list = field(default_factory=list)
    ids: list = field(default_factory=list)

    @property
    def cutoff(self):
        """No row below it can enter; None while there is room."""
        return self.scores[-1] if len(self.scores) == self.k else None

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        keep = np.ones(len(scores), bool)
        for bound, ok in ((self.low, np.greater_equal), (self.high, np.less_equal), (self.cutoff, np.greater_equal)):
            if bound is not None:
                keep &= ok(scores, bound).astype(bool)
        if keep.any():
            rows = sorted([*zip(self.scores, self.ids), *zip(scores[keep].tolist(), ids[keep].tolist())], key=lambda r: (-r[0], r[1]))[: self.k]
            self.scores, self.ids = [s for s, _ in rows], [i for _, i in rows]


def _wanted(best: Best, low: np.ndarray, high: np.ndarray, late: bool) -> np.ndarray:
    """Candidates that one window may still take."""
    keep = np.ones(len(low), bool)
    if best.low is not None:
        keep &= (high >= best.low) & (low <= best.high)
    cutoff = best.cutoff
    if late:
        # Rows that lie in the window whatever comes: the k-th best of their lower bounds is certain.
        sure = low if best.low is None else low[(low >= best.low) & (high <= best.high)]
        if len(sure) >= best.k:
            certain = np.sort(sure)[-best.k]
            cutoff = certain if cutoff is None else max(cutoff, certain)
    if cutoff is not None:
        keep &= high >= cutoff
    return keep


class Block:
    """Columnar vectors of one length."""

    def __init__(self, dim: int, ids: bytes, labels: bytes, data: bytes):
        self.ids, self.labels = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64)
        self.data = np.frombuffer(data, np.float64).reshape(dim, len(self.ids))
        self.least, self.most = self.data.min(axis=1, initial=np.inf), self.data.max(axis=1, initial=-np.inf)
        self.largest = float(np.abs(self.data).max(initial=0))
        self._whole: tuple | None = None

    def columns(self, exact: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not exact:
            return self.data, self.least, self.most
        if self._whole is None:
            self._whole = tuple(map(_integers, (self.data, self.least, self.most)))
        return self._whole


def vertical_scan(anchor: np.ndarray, order: np.ndarray, block: Block, rows: np.ndarray, windows: list[Best]) -> int:
    """Put what the windows want of the block's ``rows`` into them; returns how many component values were read."""
    dim = len(anchor)
    exact = float(np.abs(anchor).max(initial=0)) * block.largest * max(dim, 1) >= _EXACT
    data, least, most = block.columns(exact)
    a = _integers(anchor) if exact else anchor
    ends = np.stack([a * least, a * most]) if dim else np.zeros((2, 0))
    ahead = lambda x: np.append(np.cumsum(x[order][::-1])[::-1], 0)  # noqa: E731  what the dimensions from each place on contribute
    low_rest, high_rest = ahead(ends.min(axis=0)), ahead(ends.max(axis=0))
    total = np.zeros(len(rows), object if exact else np.float64)
    seen = 0
    for j in range(0, dim, STEP):
        dims = order[j : j + STEP]
        total = total + a[dims] @ (data[dims] if len(rows) == data.shape[1] else data[np.ix_(dims, rows)])
        seen += len(dims) * len(rows)
        at = min(j + STEP, dim)
        if at < dim:
            low, high = total + low_rest[at], total + high_rest[at]
            keep = np.zeros(len(rows), bool)
            for w in windows:
                keep |= _wanted(w, low, high, 2 * at >= dim).astype(bool)
            if not keep.any():
                return seen
            if keep.sum() < 0.8 * len(rows):
                rows, total = rows[keep], total[keep]
    for w in windows:
        w.add(total, block.ids[rows])
    return seen


def _scan(anchors, k: int, same_label: bool):
    """The best rows of each anchor's windows in a task's blocks.

    ``anchors`` broadcasts (ids, labels, vectors, windows): windows by anchor as (slot, low, high), or None for a window without ends.
    """

    def apply(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors, windows = anchors.value
        orders = [np.argsort(-np.abs(v), kind="stable") for v in vectors]
        best = [[(0, Best(k))] if windows is None else [(slot, Best(k, low, high)) for slot, low, high in windows.get(i, ())] for i in ids]
        for part in parts:
            for r in range(part.num_rows):
                block = Block(part["dim"][r].as_py(), *(part[c][r].as_py() for c in ("ids", "labels", "data")))
                by_label: dict[int, np.ndarray] = {}
                for i, label, vector, order, own in zip(ids, labels, vectors, orders, best):
                    if not own or len(vector) != len(block.data):
                        continue
                    if label not in by_label:
                        by_label[label] = np.flatnonzero((block.labels == label) == same_label)
                    rows = by_label[label]
                    if same_label:
                        rows = rows[block.ids[rows] != i]
                    if len(rows):
                        vertical_scan(vector, order, block, rows, [w for _, w in own])
        for i, own in zip(ids, best):
            found = [(i, slot, v, s) for slot, w in own for s, v in zip(w.scores, w.ids)]
            if found:
                a, slots, v, s = zip(*found)
                held = [max(-_LONG - 1, min(_LONG, int(x))) for x in s]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (a, slots, v, held)], schema=_FOUND)

    return tidy(apply)


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _mine_group(spark: SparkSession, blocks: DataFrame, group: list, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    """Results of one group of at most GROUP anchors."""
    ids, labels = [r["id"] for r in group], [r["label"] for r in group]
    vectors = [np.frombuffer(r["data"], np.float64) for r in group]
    anchors = spark.sparkContext.broadcast((ids, labels, vectors, None))
    near = _stored(_first(blocks.mapInArrow(_scan(anchors, positives, True), _FOUND_DDL), positives).drop("slot"), "negatives-positives")
    windows: dict[int, list[tuple[int, int, int]]] = {}
    for r in near.collect():  # at most GROUP * positives rows
        lower, upper = -(-low * r["score"] // 100), high * r["score"] // 100
        if lower <= upper:
            windows.setdefault(r["anchor_id"], []).append((r["rank"], lower, upper))
    wanted = spark.sparkContext.broadcast((ids, labels, vectors, windows))
    found = _first(blocks.mapInArrow(_scan(wanted, negatives, False), _FOUND_DDL), negatives)
    own = near.select("anchor_id", F.col("rank").cast("long").alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return found.join(own, ["anchor_id", "slot"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def mine(rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 10, scale: int = 256, low: int = 30, high: int = 90) -> DataFrame:
    """Hard negatives: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` needs ``vec_id``, ``embedding`` and ``label``; other columns are ignored. Components count as
    floor(scale * x), and a score is the integer inner product with the anchor. The anchors are the rows of which the
    condition ``anchors`` holds; of several rows with one id the one with the smallest label and
    vector is the anchor. An anchor's positives are its first rows of the same label with other ids; for each of them the first rows of other
    labels come back whose score lies between ``low`` and ``high`` percent of the positive's. Higher scores
    come first, ties go to the smaller id.

    Rows without an id or a label, with a null vector, or with null or non-finite components take no part. Vectors
    of another length than the anchor's aren't compared with it. Repeated rows are candidates as often as they are there. Anchors
    with fewer rows to choose from return fewer; a positive with a score below zero has no negatives, as its window is empty. Scores outside the long
    range are held at its ends. Empty tables give an empty result.
    """
    if min(positives, negatives) < 1:
        raise ValueError("positives and negatives must be positive")
    spark = rows.sparkSession
    used = rows.select(
        F.col("vec_id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), F.col("embedding").alias("vector"), F.coalesce(anchors, F.lit(False)).alias("anchor")
    ).where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    blocks = _stored(used.drop("anchor").mapInArrow(_columnar(scale, BLOCK), "dim int, ids binary, labels binary, data binary"), "negatives-blocks")
    singles = used.where("anchor").drop("anchor").mapInArrow(_single(scale), "id long, label long, data binary")
    one = singles.groupBy("id").agg(F.min(F.struct("label", "data")).alias("_v")).select("id", "_v.label", "_v.data")
    placed = with_global_position(one, [F.col("id")], "_at")
    numbered = _stored(placed.select("id", "label", "data", F.floor(F.col("_at") / GROUP).cast("long").alias("group")), "negatives-anchors")
    path = scratch_path(spark, "negatives-result")
    spark.createDataFrame([], _RESULT).write.parquet(path)
    for r in numbered.select("group").distinct().orderBy("group").toLocalIterator():
        group = numbered.where(F.col("group") == r["group"]).orderBy("id").collect()  # at most GROUP rows
        _mine_group(spark, blocks, group, positives, negatives, low, high).write.mode("append").parquet(path)
    return spark.read.schema(_RESULT).parquet(path)
