"""Cleaning, standardisation and recomputed financials."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake import schema
from orderlake.functions import (
    between_or_null,
    in_domain,
    initcap_trim,
    lower_trim,
    money,
    positive_or_null,
)


def clean_and_standardize(df: DataFrame) -> DataFrame:
    """Apply the cleaning rules in dependency order.

    1. Text: status, payment method and e-mail lower-cased and trimmed;
       category title-cased and trimmed; region trimmed.
    2. Status outside the known set, non-positive price and quantity outside
       [1, 100] become null; ``order_date`` text becomes a timestamp (null
       when unparsable).
    3. Gross, discount and net are recomputed from quantity, price and
       discount percent in exact decimals, rounding half-up to cents. Any
       incoming values are discarded. A null input makes them null.
    """
    low, high = schema.QUANTITY_RANGE
    df = df.withColumns(
        {
            "status": lower_trim("status"),
            "category": initcap_trim("category"),
            "region": F.trim(F.col("region")),
            "payment_method": lower_trim("payment_method"),
            "customer_email": lower_trim("customer_email"),
        }
    )
    df = df.withColumns(
        {
            "status": in_domain(F.col("status"), schema.VALID_STATUSES),
            "unit_price": money(
                positive_or_null(F.col("unit_price")), schema.UNIT_PRICE_TYPE
            ),
            "discount_pct": money("discount_pct", schema.DISCOUNT_PCT_TYPE),
            "quantity": between_or_null(F.col("quantity"), low, high),
            "order_date": F.try_to_timestamp(
                F.col("order_date"), F.lit(schema.TIMESTAMP_FORMAT)
            ),
        }
    )
    # quantity <= 100 and price < 1e10, so gross always fits 14 digits.
    df = df.withColumn(
        "gross_revenue",
        (F.col("quantity") * F.col("unit_price")).cast(schema.AMOUNT_TYPE),
    )
    one_percent = F.lit("0.01").cast("decimal(3,2)")
    df = df.withColumn(
        "discount_amount",
        money(
            F.round(F.col("gross_revenue") * F.col("discount_pct") * one_percent, 2),
            schema.AMOUNT_TYPE,
        ),
    )
    return df.withColumn(
        "net_revenue",
        money(F.col("gross_revenue") - F.col("discount_amount"), schema.AMOUNT_TYPE),
    )
