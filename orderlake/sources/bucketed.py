"""Bronze stored in buckets by order id, so that deduplication and merges move no rows.

All copies of an order lie in one bucket, and a task reads a bucket: the window of the deduplication, and a join with
another table in the same buckets, find their rows where they are. The table is an external one: its files lie in
the given folder, and the session's catalog only holds its columns and buckets. Appends go through the same commits as
plain bronze.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from orderlake import schema
from orderlake.sources.commits import append_once, new_key
from orderlake.sources.sinks import observed_write

KEY = schema.DEDUP_KEY
#: Rows of a bucket, which one task sorts.
ROWS_PER_BUCKET = 1_000_000


def buckets_for(rows: int, least: int) -> int:
    """Buckets for a table of about so many rows, at least ``least``: a task's rows stay bounded as the table grows."""
    return max(least, -(-rows // ROWS_PER_BUCKET))


def bucketed_table(spark: SparkSession, path: str, name: str, buckets: int, columns=schema.BRONZE_SCHEMA) -> DataFrame:
    """The table ``name`` over the files in ``path``, defined in this session's catalog if it isn't there.

    The number of buckets belongs to the stored files: it must be the one that they were written with.
    """
    if not spark.catalog.tableExists(name):
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns.fields)
        where = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE TABLE `{name}` ({ddl}) USING parquet CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {int(buckets)} BUCKETS LOCATION '{where}'")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def append_bucketed(df: DataFrame, path: str, buckets: int, run_key: str | None = None) -> int:
    """Append rows to the bucketed files in ``path``, once for each run key; returns the rows written.

    Rows are dealt to one task for each bucket, which writes one sorted file. Rows without an order id don't belong into
    bronze; they would share a bucket.
    """
    spark = df.sparkSession

    def stage(staged: str) -> dict[str, int]:
        # Only a table can be written in buckets: this one is dropped again and leaves its files behind.
        name = f"staged_{uuid.uuid4().hex}"
        dealt = df.select(*[f.name for f in schema.BRONZE_SCHEMA.fields]).repartition(buckets, KEY)
        try:
            rows = observed_write(
                dealt,
                lambda d: d.write.format("parquet").option("path", staged).bucketBy(buckets, KEY).sortBy(KEY).saveAsTable(name),
                "bucketed",
            )
        finally:
            spark.sql(f"DROP TABLE IF EXISTS `{name}`")
        return {"rows": rows}

    return append_once(spark, path, run_key or new_key(), stage)["rows"]
