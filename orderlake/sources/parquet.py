"""Layer readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderlake import schema
from orderlake.operators.marts import completed_orders
from orderlake.sources.commits import without_open_runs


def read_bronze(spark: SparkSession, bronze_path: str) -> DataFrame:
    """Bronze Parquet; an empty layer gives no rows. Runs that are being published now are left out."""
    return without_open_runs(spark.read.schema(schema.BRONZE_SCHEMA).parquet(bronze_path), bronze_path)


def read_silver(spark: SparkSession, silver_path: str, completed_only: bool = True) -> DataFrame:
    """Silver Parquet; by default only completed orders (pushed to the scan). An empty layer gives no rows.

    A merge that is being published now is left out.
    """
    df = without_open_runs(spark.read.schema(schema.SILVER_SCHEMA).parquet(silver_path), silver_path)
    return completed_orders(df) if completed_only else df


def read_quarantine(spark: SparkSession, quarantine_path: str) -> DataFrame:
    """Rows that failed validation, with their reasons, the corrupt text and the metadata of their run."""
    return spark.read.schema(schema.QUARANTINE_SCHEMA).parquet(quarantine_path)
