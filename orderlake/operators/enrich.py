"""Derived silver columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake import schema
from orderlake.functions import revenue_bucket


def add_silver_columns(
    df: DataFrame,
    null_bucket: str | None = schema.TOP_BUCKET,
    transformed_at: Column | None = None,
) -> DataFrame:
    """Revenue bucket, discount flag, quarter, ISO week and a load time."""
    return df.withColumns(
        {
            "revenue_bucket": revenue_bucket(F.col("net_revenue"), null_bucket),
            "is_discounted": F.col("discount_pct") > 0,
            "order_quarter": F.quarter("order_date"),
            "order_week": F.weekofyear("order_date"),
            "_transformed_at": transformed_at
            if transformed_at is not None
            else F.current_timestamp(),
        }
    )
