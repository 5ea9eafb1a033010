"""Raw orders built from normalised order tables.

The given tables hold line items, orders, customers, nations, regions and
parts. Joined, every line item becomes one raw order row with the raw
23-field layout. A few deterministic field faults are injected so the
validation and cleaning rules have work to do; every line item is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake import schema
from orderlake.operators.metadata import add_ingestion_metadata
from orderlake.operators.quality import validate_schema

SOURCE_LABEL = "tables://lineitem"

# Fault injection keyed on the order number; rows are corrupted, not dropped.
NULL_ID_EVERY = 97  # order_id missing -> quarantined
BAD_QUANTITY_EVERY = 83  # quantity + 100 -> out of range
NEGATIVE_PRICE_EVERY = 89  # price negated -> nulled
BAD_STATUS_EVERY = 79  # status outside the known set


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _numbered(prefix: str, number: Column, digits: int) -> Column:
    """``format_string(f"{prefix}%0{digits}d", number)``, without a formatter's work for numbers of at most so many digits."""
    padded = F.concat(F.lit(prefix), F.lpad(number.cast("string"), digits, "0"))
    return F.when(number.between(0, 10**digits - 1), padded).otherwise(F.format_string(f"{prefix}%0{digits}d", number))


def raw_orders_from_tables(spark: SparkSession, sf_dir: str, scan_tasks: int | None = None, by_month: bool = False) -> DataFrame:
    """All line items as raw order rows (strings, ints and doubles).

    Line items are joined to parts first and to orders, with their customers, last: they are shuffled at most twice, and an order's
    line items stay side by side, in which they compress best in all that is written of them. Only table columns move; nations and regions are joined behind
    the shuffles, and the raw fields are made there. Small dimensions are broadcast by
    Catalyst from their measured size. ``by_month`` groups the rows by order year and month, for what is written by month.
    ``scan_tasks`` deals the line items out to so many
    tasks, for a table stored as a few large row groups, which one task each would read, join and write out;
    by default the scan's splits stay.
    """
    t = lambda name: _table(spark, sf_dir, name)
    line = t("lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        "l_quantity",
        "l_discount",
        "l_returnflag",
        "l_shipdate",
    )
    if scan_tasks:
        line = line.repartition(scan_tasks)
    orders = (
        t("orders")
        .select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
        .join(t("customer").select("c_custkey", "c_name", "c_nationkey"),
              F.col("o_custkey") == F.col("c_custkey"))
        .drop("c_custkey")
    )
    part = t("part").select("p_partkey", "p_name", "p_type", "p_retailprice")
    nations = (
        t("nation").select("n_nationkey", "n_name", "n_regionkey")
        .join(t("region").select("r_regionkey", "r_name"),
              F.col("n_regionkey") == F.col("r_regionkey"))
    )
    rows = line.join(part, F.col("l_partkey") == F.col("p_partkey")).drop("p_partkey").join(
        orders, F.col("l_orderkey") == F.col("o_orderkey")
    ).drop("o_orderkey")
    if by_month:
        rows = (
            rows.withColumns({"_year": F.year("o_orderdate"), "_month": F.month("o_orderdate")})
            .hint("rebalance", "_year", "_month")
            .drop("_year", "_month")
        )
    rows = rows.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    key = F.col("l_orderkey")

    def every(n: int):
        return key % n == 0

    text_ts = lambda c: F.date_format(F.col(c), schema.TIMESTAMP_FORMAT)
    status = (
        F.when(every(BAD_STATUS_EVERY), F.lit("UNKNOWN"))
        .when(F.col("l_returnflag") == "R", F.lit("Refunded"))
        .when(F.col("o_orderstatus") == "F", F.lit(" COMPLETED "))
        .when(F.col("o_orderstatus") == "O", F.lit("Pending"))
        .otherwise(F.lit("completed"))
    )
    zero = F.lit(0.0)
    return rows.select(
        F.when(~every(NULL_ID_EVERY),
               F.concat(_numbered("ORD-", key, 8), F.lit("-"), F.coalesce(F.col("l_linenumber").cast("string"), F.lit("null")))).alias("order_id"),
        _numbered("CUST-", F.col("o_custkey"), 6).alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.concat(F.lit(" "), F.upper(F.replace(F.col("c_name"), F.lit("#"), F.lit("."))),
                 F.lit("@EXAMPLE.com ")).alias("customer_email"),
        F.col("r_name").alias("region"),
        F.col("n_name").alias("city"),
        F.col("n_name").alias("state"),
        _numbered("PROD-", F.col("l_partkey"), 6).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.upper(F.col("p_type")).alias("category"),
        (F.col("l_quantity").cast("int")
         + F.when(every(BAD_QUANTITY_EVERY), F.lit(100)).otherwise(F.lit(0))).alias("quantity"),
        F.when(every(NEGATIVE_PRICE_EVERY), -F.col("p_retailprice"))
        .otherwise(F.col("p_retailprice")).alias("unit_price"),
        F.round(F.col("l_discount") * 100, 0).alias("discount_pct"),
        zero.alias("discount_amount"),
        zero.alias("gross_revenue"),
        zero.alias("net_revenue"),
        F.col("o_orderpriority").alias("payment_method"),
        status.alias("status"),
        text_ts("o_orderdate").alias("order_date"),
        F.year("o_orderdate").alias("order_year"),
        F.month("o_orderdate").alias("order_month"),
        F.dayofmonth("o_orderdate").alias("order_day"),
        text_ts("l_shipdate").alias("created_at"),
    )


def bronze_from_tables(spark: SparkSession, sf_dir: str, scan_tasks: int | None = None, by_month: bool = False) -> DataFrame:
    """Validated raw orders with metadata, as the bronze layer holds them; ``by_month`` groups them as it is partitioned.

    Each row's ``created_at`` stands for its arrival time, as if the line
    items had come in over many ingestion runs.
    """
    raw = validate_schema(raw_orders_from_tables(spark, sf_dir, scan_tasks, by_month))
    arrival = F.try_to_timestamp(F.col("created_at"), F.lit(schema.TIMESTAMP_FORMAT))
    return add_ingestion_metadata(raw, SOURCE_LABEL, ingested_at=arrival)
