"""DataFrame -> DataFrame operators."""

from orderlake.operators.clean import clean_and_standardize
from orderlake.operators.dedup import deduplicate, duplicates_removed
from orderlake.operators.enrich import add_silver_columns
from orderlake.operators.marts import (
    build_customer_segments,
    build_product_performance,
    build_sales_by_region,
    completed_orders,
    rfm_base,
    rfm_scores,
    segment_distribution,
    sort_sales_by_region,
    top_products_by_category,
)
from orderlake.operators.metadata import add_ingestion_metadata
from orderlake.operators.quality import (
    quarantined_orders,
    validate_schema,
    validation_report,
)
from orderlake.operators.ranking import (
    distributed_rank,
    with_global_position,
    with_ntiles,
)

__all__ = [
    "add_ingestion_metadata",
    "add_silver_columns",
    "build_customer_segments",
    "build_product_performance",
    "build_sales_by_region",
    "clean_and_standardize",
    "completed_orders",
    "deduplicate",
    "distributed_rank",
    "duplicates_removed",
    "quarantined_orders",
    "rfm_base",
    "rfm_scores",
    "segment_distribution",
    "sort_sales_by_region",
    "top_products_by_category",
    "validate_schema",
    "validation_report",
    "with_global_position",
    "with_ntiles",
]
