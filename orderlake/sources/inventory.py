"""Table of the files under a folder (names, sizes, modification times)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def file_inventory(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """One row per non-empty file under ``root`` (recursive).

    Listing is done by the file source; only metadata columns are selected,
    so file contents are pruned from the scan.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(root).select("path", "length", "modificationTime")
