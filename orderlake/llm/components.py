"""Connected components of an edge table, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.session import scratch_path


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _least(both: DataFrame) -> DataFrame:
    """Per node the smallest of itself and its neighbours (combined before the shuffle)."""
    return both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """Node and smallest node of its component, for nodes with an edge.

    ``edges`` has two long columns ``a`` and ``b``. Each round links larger
    neighbours, then smaller ones, to a node's least neighbour; the edges end as
    stars around the components' least nodes, in a number of rounds that grows with
    the logarithm of the longest path. Rounds are cut by tables in the
    checkpoint folder. Loops, repeated edges and empty tables are fine.
    """
    edges = _stored(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges"
    )
    before = None
    while True:
        # Large star: larger neighbours are linked to the least neighbour.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.where("b > a").join(_least(both), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        # Small star: a node and its smaller neighbours are linked to the least of them.
        small = large.join(large.groupBy("a").agg(F.min("b").alias("m")), "a")
        edges = _stored(
            small.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(small.select("a", F.col("m").alias("b")))
            .where("a <> b")
            .distinct(),
            "edges",
        )
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
