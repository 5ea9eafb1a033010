"""Layer checks: one row per rule with its number of violations.

The rules of a layer are aggregates over its rows. :func:`observed` counts them while the layer is written, so
checking costs no scan; the ``*_checks`` functions count them on a stored layer, in one aggregation each.
Duplicates are counted on the rows before they are written, as rows behind the first of their key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from orderlake import schema
from orderlake.operators.quality import validity

#: Marks rows behind the first of their key; it isn't part of any layer.
COPY = "_copy_of_key"
KEYS = {
    "silver": ["order_id"],
    "gold.sales_by_region": ["region", "order_year", "order_month"],
    "gold.product_performance": ["product_id"],
}
_DUPLICATES = {"silver": "duplicate_order_id", "gold.sales_by_region": "duplicate_region_month", "gold.product_performance": "duplicate_product_id"}


def rules(layer: str) -> dict[str, Column]:
    """Rule names and aggregates of a layer, without duplicates of its key."""
    low, high = schema.QUANTITY_RANGE
    buckets = [label for _, label in schema.REVENUE_BUCKETS] + [schema.TOP_BUCKET]
    labels = [label for _, label in schema.SEGMENTS] + [schema.LAST_SEGMENT]
    found = {
        "bronze": {"missing_required_field": F.count_if(~validity())} if layer == "bronze" else {},
        "silver": {
            "status_outside_domain": F.count_if(F.col("status").isNotNull() & ~F.col("status").isin(schema.VALID_STATUSES)),
            "non_positive_price": F.count_if(F.col("unit_price") <= 0),
            "quantity_out_of_range": F.count_if(~F.col("quantity").between(low, high)),
            "bucket_outside_domain": F.count_if(~F.col("revenue_bucket").isin(buckets)),
            "unknown_category": F.count_if(F.col("category").isNotNull() & ~F.col("category").isin(schema.VALID_CATEGORIES)),
        },
        "gold.sales_by_region": {
            "negative_revenue": F.count_if(F.col("total_revenue") < 0),
            "rank_not_starting_at_one": F.when(F.count(F.lit(1)) > 0, (F.min("revenue_rank") != 1).cast("int")).otherwise(0),
        },
        "gold.product_performance": {"rank_below_one": F.count_if(F.col("rank_in_category") < 1)},
        "gold.customer_segments": {
            "segment_outside_domain": F.count_if(~F.col("segment").isin(labels)),
            "frequency_below_one": F.count_if(F.col("frequency") < 1),
            "negative_monetary": F.count_if(F.col("monetary") < 0),
        },
    }
    return found[layer]


def with_copies(df: DataFrame, layer: str) -> DataFrame:
    """Rows with a mark on those behind the first of their key.

    Placed where the rows lie together by that key already, it sorts and moves nothing anew.
    """
    key = KEYS[layer]
    return df.withColumn(COPY, F.row_number().over(Window.partitionBy(*key).orderBy(*key)) > 1)


def observed(df: DataFrame, layer: str) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """``df`` without its mark of copies, and what gives the violations by rule once it has been written."""
    seen = Observation(f"rules {layer}")
    found = rules(layer)
    if COPY in df.columns:
        found = {_DUPLICATES[layer]: F.count_if(F.col(COPY))} | found
    counted = df.observe(seen, *[expr.cast("long").alias(name) for name, expr in found.items()]).drop(COPY)
    return counted, lambda: {f"{layer}.{name}": int(n) for name, n in seen.get.items()}


def _report(df: DataFrame, layer: str, rules: dict[str, Column]) -> DataFrame:
    counts = df.agg(*[expr.cast("long").alias(name) for name, expr in rules.items()])
    stacked = ", ".join(f"'{name}', `{name}`" for name in rules)
    return counts.selectExpr(
        f"stack({len(rules)}, {stacked}) AS (rule, violations)"
    ).select(F.lit(layer).alias("layer"), "rule", "violations")


def _duplicates(cols: list[str]) -> Column:
    return F.count(F.lit(1)) - F.count_distinct(*[F.col(c) for c in cols])


def _checks(df: DataFrame, layer: str) -> DataFrame:
    duplicates = {_DUPLICATES[layer]: _duplicates(KEYS[layer])} if layer in KEYS else {}
    return _report(df, layer, duplicates | rules(layer))


def bronze_checks(bronze: DataFrame) -> DataFrame:
    return _checks(bronze, "bronze")


def silver_checks(silver: DataFrame) -> DataFrame:
    return _checks(silver, "silver")


def gold_checks(sales: DataFrame, products: DataFrame, segments: DataFrame) -> DataFrame:
    return (
        _checks(sales, "gold.sales_by_region")
        .unionByName(_checks(products, "gold.product_performance"))
        .unionByName(_checks(segments, "gold.customer_segments"))
    )
