"""Exact distinct counts that can be merged: bitmaps over numbered values.

Values are numbered once, densely, and keep their numbers when later values join them. A group's distinct values are then a
few bitmaps, one for each bucket of 32,768 numbers; the bitmaps of two groups merge by *or*, so a year is made of its
months and all regions of each region, without reading an order again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.operators.ranking import with_global_position

NUMBER, BUCKET, BITMAP = "_number", "_bucket", "_bitmap"


def fresh_numbers(values: DataFrame, column: str, known: DataFrame | None = None) -> DataFrame:
    """Numbers of the distinct non-null values that ``known`` doesn't have, behind its numbers: ``column`` and ``_number``."""
    fresh = values.select(column).where(F.col(column).isNotNull()).distinct()
    start = 0
    if known is not None:
        fresh = fresh.join(known.select(column), column, "left_anti")
        start = known.agg(F.max(NUMBER)).first()[0] or 0
    placed = with_global_position(fresh, [F.col(column)], "_at", "_all")
    return placed.select(column, (F.lit(start).cast("long") + F.col("_at") + 1).alias(NUMBER))


def numbered(values: DataFrame, column: str, known: DataFrame | None = None) -> DataFrame:
    """Each distinct non-null value of ``column`` with its number (from 1): ``column`` and ``_number``.

    ``known`` is an earlier result: its numbers stay, and only new values get new ones behind them. Numbers of new values follow the
    values' order, so the same inputs give the same numbers.
    """
    new = fresh_numbers(values, column, known)
    return new if known is None else known.select(column, NUMBER).unionByName(new)


def distinct_bitmaps(df: DataFrame, groups: Sequence[str], column: str, numbers: DataFrame) -> DataFrame:
    """The distinct values of ``column`` in each group as bitmaps: ``groups``, ``_bucket`` and ``_bitmap``.

    Groups without a value have no row. Rows meet in partial bitmaps before the shuffle by group and bucket: what
    moves is at most four kilobytes for each task, group and bucket, however many rows a group has.
    """
    rows = df.select(*groups, column).join(numbers.select(column, NUMBER), column)
    return rows.groupBy(*groups, F.bitmap_bucket_number(NUMBER).alias(BUCKET)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(NUMBER)).alias(BITMAP)
    )


def merged_bitmaps(bitmaps: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Bitmaps of coarser groups: those that ``groups``, a part of the former columns, tell apart."""
    return bitmaps.groupBy(*groups, BUCKET).agg(F.bitmap_or_agg(BITMAP).alias(BITMAP))


def distinct_counts(bitmaps: DataFrame, groups: Sequence[str], out_col: str) -> DataFrame:
    """Exact number of distinct values in each (coarser) group that has any."""
    merged = merged_bitmaps(bitmaps, groups)
    return merged.groupBy(*groups).agg(F.sum(F.bitmap_count(BITMAP)).cast("long").alias(out_col))
