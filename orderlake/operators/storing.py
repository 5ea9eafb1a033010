"""Intermediate tables under the session's checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from orderlake.session import scratch_path


def stored_rows(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """Write ``df`` once under the checkpoint folder, in a small form; the table read back and its row count."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), int(seen.get["rows"])
