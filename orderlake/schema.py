"""Schemas, column groups and fixed domain values for raw orders."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DecimalType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Raw order layout. CSV binds by position, so the order of fields matters.
# ---------------------------------------------------------------------------
# The raw fields and their types must equal the source system's.
# ---------------------------------------------------------------------------
RAW_SCHEMA = StructType(
    [
        StructField("order_id", StringType()),
        StructField("customer_id", StringType()),
        StructField("customer_name", StringType()),
        StructField("customer_email", StringType()),
        StructField("region", StringType()),
        StructField("city", StringType()),
        StructField("state", StringType()),
        StructField("product_id", StringType()),
        StructField("product_name", StringType()),
        StructField("category", StringType()),
        StructField("quantity", IntegerType()),
        StructField("unit_price", DoubleType()),
        StructField("discount_pct", DoubleType()),
        StructField("discount_amount", DoubleType()),
        StructField("gross_revenue", DoubleType()),
        StructField("net_revenue", DoubleType()),
        StructField("payment_method", StringType()),
        StructField("status", StringType()),
        StructField("order_date", StringType()),
        StructField("order_year", IntegerType()),
        StructField("order_month", IntegerType()),
        StructField("order_day", IntegerType()),
        StructField("created_at", StringType()),
    ]
)

RAW_COLUMNS = [f.name for f in RAW_SCHEMA.fields]
CORRUPT_COLUMN = "_corrupt_record"
REASONS_COLUMN = "_quarantine_reasons"
RAW_SCHEMA_WITH_CORRUPT = StructType(
    RAW_SCHEMA.fields + [StructField(CORRUPT_COLUMN, StringType())]
)

METADATA_COLUMNS = ["_ingested_at", "_source_path", "_pipeline_run_id"]
BRONZE_COLUMNS = RAW_COLUMNS + METADATA_COLUMNS
SILVER_EXTRA_COLUMNS = [
    "revenue_bucket",
    "is_discounted",
    "order_quarter",
    "order_week",
    "_transformed_at",
]
SILVER_COLUMNS = BRONZE_COLUMNS + SILVER_EXTRA_COLUMNS
BRONZE_SCHEMA = StructType(
    RAW_SCHEMA.fields
    + [
        StructField("_ingested_at", TimestampType()),
        StructField("_source_path", StringType()),
        StructField("_pipeline_run_id", StringType()),
    ]
)
QUARANTINE_SCHEMA = StructType(
    BRONZE_SCHEMA.fields + [StructField(CORRUPT_COLUMN, StringType()), StructField(REASONS_COLUMN, ArrayType(StringType()))]
)
_SILVER_TYPES = {
    "unit_price": DecimalType(12, 2),
    "discount_pct": DecimalType(5, 2),
    "discount_amount": DecimalType(14, 2),
    "gross_revenue": DecimalType(14, 2),
    "net_revenue": DecimalType(14, 2),
    "order_date": TimestampType(),
}
SILVER_SCHEMA = StructType(
    [StructField(f.name, _SILVER_TYPES.get(f.name, f.dataType)) for f in BRONZE_SCHEMA.fields]
    + [
        StructField("revenue_bucket", StringType()),
        StructField("is_discounted", BooleanType()),
        StructField("order_quarter", IntegerType()),
        StructField("order_week", IntegerType()),
        StructField("_transformed_at", TimestampType()),
    ]
)

# Money is carried as exact decimals from the silver layer on.
UNIT_PRICE_TYPE = "decimal(12,2)"
DISCOUNT_PCT_TYPE = "decimal(5,2)"
AMOUNT_TYPE = "decimal(14,2)"
MONEY_COLUMNS = [
    "unit_price",
    "discount_pct",
    "discount_amount",
    "gross_revenue",
    "net_revenue",
]

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
RUN_ID_FORMAT = "yyyy-MM-dd'T'HHmmss"

BRONZE_PARTITIONS = ["order_year", "order_month"]
SILVER_PARTITIONS = ["order_year", "order_month", "category"]

# Deduplication keeps the latest arrival per order. Arrival time alone ties
# inside one run, so the remaining columns (in this order, ascending) make
# the choice total and repeatable.
DEDUP_KEY = "order_id"
DEDUP_TIEBREAK = [
    c
    for c in BRONZE_COLUMNS
    if c not in ("order_id", "_ingested_at", "created_at")
]

# ---------------------------------------------------------------------------
# Fixed values. These must equal the source system's values for results to
# match; they are stated here as plain text, in their natural order.
# ---------------------------------------------------------------------------
REQUIRED_COLUMNS = ["order_id", "customer_id", "product_id"]
VALID_STATUSES = ["completed", "pending", "cancelled", "refunded"]
VALID_CATEGORIES = [
    "Electronics",
    "Clothing",
    "Books",
    "Home & Garden",
    "Sports",
    "Food & Beverages",
]
PAYMENT_METHODS = ["credit_card", "debit_card", "pix", "boleto", "paypal"]
REGIONS = ["Norte", "Nordeste", "Centro-Oeste", "Sudeste", "Sul"]
DISCOUNT_CHOICES = [0, 0, 0, 5, 10, 15, 20]
QUANTITY_RANGE = (1, 100)
GENERATED_QUANTITY_RANGE = (1, 10)
GENERATED_PRICE_RANGE = (9.99, 999.99)
# Revenue buckets: net revenue below each bound; anything else is premium.
REVENUE_BUCKETS = [(100, "low"), (500, "medium"), (2000, "high")]
TOP_BUCKET = "premium"
# RFM segments: minimum summed score for each label, checked top-down.
SEGMENTS = [
    (13, "Champions"),
    (10, "Loyal Customers"),
    (7, "Potential Loyalists"),
    (5, "At Risk"),
]
LAST_SEGMENT = "Lost"
RFM_TILES = 5
COMPLETED = "completed"
