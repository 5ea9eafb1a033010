"""Ingestion as a file stream: only files not seen before are ingested.

The batch job appends every matching file on each run, so a rerun doubles
bronze until silver deduplicates it. Run as a stream with a checkpoint,
each file is ingested once; ``availableNow`` processes what has landed and
stops, so the job can be scheduled like a batch job.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake import schema
from orderlake.operators.metadata import add_ingestion_metadata
from orderlake.operators.quality import validate_schema
from orderlake.sources.sinks import write_bronze


def ingest_new_files(
    spark: SparkSession,
    landing_dir: str,
    bronze_dir: str,
    checkpoint_location: str,
    max_files_per_trigger: int | None = None,
) -> int:
    """Ingest raw CSV files that arrived since the last run; return rows written.

    Rows get the same validation and metadata as the batch job, and batches are written as the
    batch job writes them, so both can append to the same bronze folder. The ingestion time is the
    batch's, and the run id names the stream and the batch. The run id is also the key that a batch is
    appended under, so a batch that is run again after a failure, at whatever point, is in bronze once.
    ``checkpoint_location`` must be on shared storage.
    """
    reader = (
        spark.readStream.schema(schema.RAW_SCHEMA_WITH_CORRUPT)
        .option("header", "true")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", schema.CORRUPT_COLUMN)
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = reader.csv(landing_dir)
    # The checkpoint is what makes a stream: its path tells streams apart.
    stream = hashlib.sha256(checkpoint_location.encode()).hexdigest()[:16]
    written: list[int] = []

    def store(batch: DataFrame, number: int) -> None:
        run = f"stream-{stream}-{number}"
        valid = validate_schema(batch).drop(schema.CORRUPT_COLUMN)
        rows = add_ingestion_metadata(valid, landing_dir).withColumn("_pipeline_run_id", F.lit(run))
        written.append(write_bronze(rows, bronze_dir, run_key=run))

    query = (
        raw.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint_location)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    return sum(written)
