"""Exact top-k inner products by a three-phase uniform threshold.

The components of the vectors are dealt to a few lists; a list holds the part of
the inner product that its components make up, and a score is the sum over the lists. The vectors are packed once into blocks of
near ones, each with its center and, for each list, the radius around it: they bound a list's part of any score with a
query from above. Blocks stay where they are, and the queries come to them in broadcast groups of bounded size:

1. *Gather.* Of the blocks that a task passes, a query looks into each whose bound exceeds those before it: the best entries
   of each list there are resolved. The k-th best score over all tasks is a safe cutoff: no result lies below it.
2. *Threshold.* The cutoffs go out with the queries. A block whose bound lies below the cutoff isn't read. In the others a score at the
   cutoff needs a list with at least cutoff / lists, so only lists whose bound reaches that are read, and the entries that do are collected.
3. *Resolve.* Collected entries get their exact scores from the remaining lists, and each task sends on its k best.
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

LISTS = 4
#: Vectors in a block, blocks that are formed together, queries in a broadcast group.
BLOCK = 1024
TOGETHER = 16
GROUP = 1024
_EXACT = 1 << 53
_LONG = (1 << 63) - 1

_PACKED = pa.schema([("dim", pa.int32()), ("ids", pa.binary()), ("data", pa.binary()), ("center", pa.binary()), ("radius", pa.binary())])
_PACKED_DDL = "dim int, ids binary, data binary, center binary, radius binary"
_ROWS = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
_ROWS_DDL = "query_id long, vec_id long, score long"
_RESULT = "query_id long, rank int, vec_id long, score long"


def scaled(vector: pa.Scalar, scale: int) -> np.ndarray | None:
    """floor(scale * x) of each component; None if the vector takes no part."""
    if not vector.is_valid:
        return None
    values = vector.values
    if values is None or values.null_count:
        return None
    x = np.floor(scale * values.to_numpy(zero_copy_only=False).astype(np.float64))
    return x if np.isfinite(x).all() else None


def cuts_of(dim: int) -> list[tuple[int, int]]:
    """The components of each list."""
    at = np.linspace(0, dim, LISTS + 1).astype(int)
    return list(zip(at[:-1].tolist(), at[1:].tolist()))


def near_blocks(x: np.ndarray, size: int) -> list[np.ndarray]:
    """Rows of x in blocks of at most ``size`` near ones: each goes to the nearest of some rows that lie far apart."""
    n = len(x)
    if n <= size or not x.shape[1]:
        return [np.arange(a, min(n, a + size)) for a in range(0, n, size)]
    with np.errstate(over="ignore", invalid="ignore"):  # vectors of any size: what overflows makes poorer blocks
        pivot, nearest, least = 0, np.zeros(n, np.int64), np.full(n, np.inf)
        for p in range(-(-n // size)):
            away = np.nan_to_num(((x - x[pivot]) ** 2).sum(axis=1), nan=np.inf)
            closer = away < least
            nearest[closer], least[closer] = p, away[closer]
            pivot = int(np.argmax(least))
    order = np.argsort(nearest, kind="stable")
    starts = np.flatnonzero(np.append(True, np.diff(nearest[order]) > 0))
    return [part[a : a + size] for part in np.split(order, starts[1:]) for a in range(0, len(part), size)]


def _pack(scale: int, size: int, together: int):
    """Blocks of scaled vectors of one length, with their centers and radii."""

    def apply(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[int, np.ndarray]]] = {}

        def blocks(dim: int) -> Iterator[pa.RecordBatch]:
            ids, rows = zip(*held.pop(dim))
            ids, x = np.array(ids, np.int64), np.stack(rows)
            for rows in near_blocks(x, size):
                own = x[rows]
                with np.errstate(over="ignore", invalid="ignore"):
                    center = own.mean(axis=0)
                    apart = (own - center) ** 2
                    radius = np.array([np.sqrt(apart[:, a:b].sum(axis=1)).max(initial=0) for a, b in cuts_of(dim)])
                cells = (ids[rows], own, center, radius)
                yield pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), *(pa.array([c.tobytes()], pa.binary()) for c in cells)], schema=_PACKED)

        for part in parts:
            for key, vector in zip(part["id"].to_pylist(), part["vector"]):
                x = scaled(vector, scale)
                if x is None or key is None:
                    continue
                held.setdefault(len(x), []).append((key, x))
                if len(held[len(x)]) == size * together:
                    yield from blocks(len(x))
        for dim in list(held):
            yield from blocks(dim)

    return tidy(apply)


class Block:
    """Candidates of one length. Queries are cut or filled with zeros to that length."""

    def __init__(self, dim: int, ids: bytes, data: bytes, center: bytes, radius: bytes):
        self.dim, self.ids = dim, np.frombuffer(ids, np.int64)
        self.x = np.frombuffer(data, np.float64).reshape(len(self.ids), dim)
        self.center, self.radius = np.frombuffer(center, np.float64), np.frombuffer(radius, np.float64)
        self.largest = float(np.abs(self.x).max(initial=0))
        self._integers: np.ndarray | None = None

    def values(self, exact: bool) -> np.ndarray:
        """The vectors, as Python's integers where doubles could round."""
        if not exact:
            return self.x
        if self._integers is None:
            self._integers = _integers(self.x)
        return self._integers


def _integers(x: np.ndarray) -> np.ndarray:
    return np.array([int(v) for v in x.ravel()], object).reshape(x.shape)


@dataclass
class Queries:
    """Queries of a group: ids, vectors, and the cutoffs that are known."""

    ids: np.ndarray
    vectors: list[np.ndarray]
    cuts: dict[int, int] = field(default_factory=dict)

    def fitted(self, dim: int) -> np.ndarray:
        out = np.zeros((len(self.ids), dim))
        for row, v in zip(out, self.vectors):
            row[: min(dim, len(v))] = v[:dim]
        return out


def bounds(q: np.ndarray, block: Block) -> np.ndarray:
    """What each list can make up at most (queries x lists), a little more for rounding."""
    out = np.zeros((len(q), LISTS))
    with np.errstate(over="ignore", invalid="ignore"):
        for k, (a, b) in enumerate(cuts_of(block.dim)):
            part, norm = q[:, a:b] @ block.center[a:b], np.sqrt((q[:, a:b] ** 2).sum(axis=1)) * block.radius[k]
            out[:, k] = part + norm + 1e-9 * (np.abs(part) + norm) + 1e-6
    return np.nan_to_num(out, nan=np.inf, posinf=np.inf)


def _inexact(q: np.ndarray, block: Block) -> bool:
    return float(np.abs(q).max(initial=0)) * block.largest * max(block.dim, 1) >= _EXACT


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    order = np.lexsort((ids, -score)) if score.dtype != object else np.array(sorted(range(len(ids)), key=lambda i: (-score[i], ids[i])), int)
    return order[:k]


def _kept(held: list[tuple[int, int]], score: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[int, int]]:
    """The k best of what is held and new (score, id), an id once."""
    near = _best(score, ids, len(ids) if len(set(ids.tolist())) < len(ids) else k)
    best: dict[int, int] = {}
    for s, i in sorted([*held, *zip(score[near].tolist(), ids[near].tolist())], key=lambda r: (-r[0], r[1])):
        best.setdefault(i, s)
        if len(best) == k:
            break
    return [(s, i) for i, s in best.items()]


def gather(q: np.ndarray, ids: np.ndarray, block: Block, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Phase 1 in a block: for each query (its place, scores and ids of) the entries that are among the k best of some list."""
    exact = _inexact(q, block)
    x, q = block.values(exact), _integers(q) if exact else q
    lists = [q[:, a:b] @ x[:, a:b].T if b > a else np.zeros((len(q), len(x)), q.dtype) for a, b in cuts_of(block.dim)]
    total = sum(lists)
    for j, own in enumerate(ids):
        seen: set[int] = set()
        for part in lists:
            row = part[j]
            top = np.argpartition(-row, k)[: k + 1] if len(row) > k + 1 and not exact else _best(row, block.ids, k + 1)
            seen.update(top.tolist())
        near = np.array([p for p in sorted(seen) if block.ids[p] != own], int)
        if len(near):
            yield j, total[j][near], block.ids[near]


def resolve(q: np.ndarray, own: int, cut: int | None, upper: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Phases 2 and 3 of a query in a block that its bound lets through: exact scores and ids of the entries at or above the cutoff."""
    exact = _inexact(q[None], block)
    x, q = block.values(exact), _integers(q[None])[0] if exact else q
    if cut is None:
        near = np.arange(len(x))
    else:
        hit = np.zeros(len(x), bool)
        for (a, b), most in zip(cuts_of(block.dim), upper):
            if exact or most * LISTS >= cut:
                part = x[:, a:b] @ q[a:b] if b > a else np.zeros(len(x))
                hit |= (part * LISTS >= cut).astype(bool)
        near = np.flatnonzero(hit)
    near = near[block.ids[near] != own]
    score = x[near] @ q if block.dim else np.zeros(len(near))
    if cut is not None and len(near):
        ok = (score >= cut).astype(bool)
        near, score = near[ok], score[ok]
    return score, block.ids[near]


def _blocks(parts: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for part in parts:
        for i in range(part.num_rows):
            yield Block(*(part[f.name][i].as_py() for f in _PACKED))


def _out(queries: Queries, held: list[list[tuple[int, int]]]) -> Iterator[pa.RecordBatch]:
    rows = [(int(q), i, max(-_LONG - 1, min(_LONG, int(s)))) for q, own in zip(queries.ids, held) for s, i in own]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=_ROWS)


def _gather(asked, k: int):
    def apply(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: Queries = asked.value
        highest = np.full(len(queries.ids), -np.inf)
        held: list[list[tuple[int, int]]] = [[] for _ in queries.ids]
        for block in _blocks(parts):
            q = queries.fitted(block.dim)
            bound = bounds(q, block).sum(axis=1)
            look = np.flatnonzero((bound > highest) | np.array([len(h) < k for h in held]))
            highest[look] = np.maximum(highest[look], bound[look])
            for j, score, ids in gather(q[look], queries.ids[look], block, k):
                held[look[j]] = _kept(held[look[j]], score, ids, k)
        yield from _out(queries, held)

    return tidy(apply)


def _resolve(asked, k: int):
    def apply(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: Queries = asked.value
        held: list[list[tuple[int, int]]] = [[] for _ in queries.ids]
        for block in _blocks(parts):
            q = queries.fitted(block.dim)
            upper = bounds(q, block)
            for j in surviving(queries, upper).tolist():
                own = int(queries.ids[j])
                score, ids = resolve(q[j], own, queries.cuts.get(own), upper[j], block)
                if len(ids):
                    held[j] = _kept(held[j], score, ids, k)
        yield from _out(queries, held)

    return tidy(apply)


def surviving(queries: Queries, upper: np.ndarray) -> np.ndarray:
    """Places of the queries for which a block with these bounds must be read."""
    cut = np.array([queries.cuts.get(int(i), -np.inf) for i in queries.ids], np.float64)
    return np.flatnonzero(upper.sum(axis=1) >= cut)


def _search(spark: SparkSession, blocks: DataFrame, group: list, k: int) -> DataFrame:
    """Results of one group of at most GROUP queries."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    queries = Queries(np.array([r["id"] for r in group], np.int64), [np.frombuffer(r["data"], np.float64) for r in group])
    first = blocks.mapInArrow(_gather(spark.sparkContext.broadcast(queries), k), _ROWS_DDL)
    # An id counts once in the cutoff, however many rows it has.
    local = first.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    cutoffs = local.withColumn("rank", F.row_number().over(order)).where(F.col("rank") == k).select("query_id", "score")
    cuts = {r["query_id"]: r["score"] for r in cutoffs.collect() if r["score"] > -_LONG - 1}  # a row for each query
    asked = spark.sparkContext.broadcast(Queries(queries.ids, queries.vectors, cuts))
    found = blocks.mapInArrow(_resolve(asked, k), _ROWS_DDL).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _single(scale: int):
    def apply(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = [(key, scaled(v, scale)) for key, v in zip(part["id"].to_pylist(), part["vector"])]
            rows = [(key, x.tobytes()) for key, x in rows if key is not None and x is not None]
            ids, data = zip(*rows) if rows else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(data, pa.binary())], names=["id", "data"])

    return tidy(apply)


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k highest integer inner products of each query: query_id, rank (from 1), vec_id, score.

    Components count as floor(scale * x). Rows with ``is_query`` are queries; candidates are all rows with another
    id. Ties go to the smaller id. Vectors that are null or hold null or non-finite components take no part, nor do
    rows without an id. Of vectors of different lengths the shorter counts as padded with
    zeros. Of rows with the same id and vector one takes part; further vectors of an id are candidates (and queries) of their own, whose best
    score counts. Scores outside the long range are held at its ends. Other columns are ignored; empty tables give an
    empty result.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"), F.coalesce(is_query, F.lit(False)).alias("q"))
    path = scratch_path(spark, "vectors")
    rows.select("id", "vector").mapInArrow(_pack(scale, BLOCK, TOGETHER), _PACKED_DDL).write.parquet(path)
    blocks = spark.read.schema(_PACKED_DDL).parquet(path)
    queries = rows.where("q").select("id", "vector").mapInArrow(_single(scale), "id long, data binary").distinct()
    placed = with_global_position(queries, [F.col("id"), F.col("data")], "_at")
    path = scratch_path(spark, "queries")
    placed.select("id", "data", F.floor(F.col("_at") / GROUP).cast("long").alias("group")).write.parquet(path)
    queries = spark.read.schema("id long, data binary, group long").parquet(path)
    path = scratch_path(spark, "nearest")
    spark.createDataFrame([], _RESULT).write.parquet(path)
    # An id's vectors may lie in two groups: the best of both counts.
    for r in queries.select("group").distinct().orderBy("group").toLocalIterator():
        group = queries.where(F.col("group") == r["group"]).orderBy("id", "data").collect()  # at most GROUP rows
        _search(spark, blocks, group, k).write.mode("append").parquet(path)
    found = spark.read.schema(_RESULT).parquet(path).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
