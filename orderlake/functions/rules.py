"""Business rules as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderlake import schema


def in_domain(col: Column, values: Sequence[str]) -> Column:
    """``col`` when it is one of ``values``, else null."""
    return F.when(col.isin(list(values)), col)


def positive_or_null(col: Column) -> Column:
    """``col`` when strictly positive, else null (zero included)."""
    return F.when(col > 0, col)


def between_or_null(col: Column, low: int, high: int) -> Column:
    """``col`` when in ``[low, high]`` inclusive, else null (no clamping)."""
    return F.when(col.between(low, high), col)


def revenue_bucket(net: Column, null_bucket: str | None = schema.TOP_BUCKET) -> Column:
    """Bucket label for net revenue.

    A null amount fails every bound and so falls through to the top bucket,
    as in the source system; pass ``null_bucket=None`` to keep it null.
    """
    expr = None
    for bound, label in schema.REVENUE_BUCKETS:
        expr = (expr.when if expr is not None else F.when)(net < bound, F.lit(label))
    expr = expr.when(net.isNotNull(), F.lit(schema.TOP_BUCKET))
    return expr.otherwise(F.lit(null_bucket))


def rfm_segment(score: Column) -> Column:
    """Segment label for a summed RFM score (3..15)."""
    expr = None
    for minimum, label in schema.SEGMENTS:
        expr = (expr.when if expr is not None else F.when)(score >= minimum, F.lit(label))
    return expr.otherwise(F.lit(schema.LAST_SEGMENT))


def run_id(ts: Column) -> Column:
    """Run id text for an ingestion time: ``2024-01-31T235959``."""
    return F.date_format(ts, schema.RUN_ID_FORMAT)
