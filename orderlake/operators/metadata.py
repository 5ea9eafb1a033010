"""Ingestion metadata columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.functions import run_id


def add_ingestion_metadata(
    df: DataFrame,
    source_path: str,
    ingested_at: Column | str | dt.datetime | None = None,
) -> DataFrame:
    """Add ``_ingested_at``, ``_source_path`` and ``_pipeline_run_id``.

    ``ingested_at`` defaults to the current UTC second, taken once on the
    driver so that every row of a run carries the same value. A Column may be
    given instead (one arrival time per row). The run id is derived from the
    ingestion time: ``2024-01-31T235959``.
    """
    if ingested_at is None:
        ingested_at = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    if isinstance(ingested_at, dt.datetime):
        ingested_at = ingested_at.strftime("%Y-%m-%d %H:%M:%S")
    if isinstance(ingested_at, str):
        ingested_at = F.lit(ingested_at).cast("timestamp")
    return df.withColumns(
        {
            "_ingested_at": ingested_at,
            "_source_path": F.lit(source_path),
        }
    ).withColumn("_pipeline_run_id", run_id(F.col("_ingested_at")))
