"""Layer writers. Each returns the number of rows written, observed during
the write itself instead of by running the plan a second time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from orderlake import schema
from orderlake.sources.commits import append_once, new_key


#: Layers are stored as small as scratch tables are.
CODEC = "zstd"
_OUTCOME, VALID, INVALID = "_outcome", "valid", "invalid"


def observed_write(df: DataFrame, write: Callable[[DataFrame], None], name: str) -> int:
    """Run ``write`` on ``df`` and return the row count seen on the way."""
    obs = Observation(name)
    write(df.observe(obs, F.count(F.lit(1)).alias("rows")))
    return int(obs.get["rows"])


def _clustered(df: DataFrame, cols: list[str]) -> DataFrame:
    """Group rows of a table partition into few tasks before a partitioned
    write. The rebalance lets adaptive execution split a partition value
    that holds a large share of rows into several tasks."""
    return df.hint("rebalance", *cols)


def write_bronze(df: DataFrame, bronze_path: str, mode: str = "append", run_key: str | None = None, clustered: bool = False) -> int:
    """Append to bronze, partitioned by order year and month. ``clustered`` rows lie grouped by these columns already.

    An append is staged and then published whole (:mod:`orderlake.sources.commits`): a failed one leaves nothing behind.
    Under a ``run_key`` it happens once, however often it is repeated, and the rows of the first time are
    returned. Without one every call is a run of its own: appending the same source twice doubles the rows, and silver
    deduplication removes the copies.
    """
    cols = schema.BRONZE_PARTITIONS

    def write(path: str, how: str) -> int:
        return observed_write(df if clustered else _clustered(df, cols), lambda d: d.write.mode(how).option("compression", CODEC).partitionBy(*cols).parquet(path), "bronze")

    if mode != "append":
        return write(bronze_path, mode)
    return append_once(df.sparkSession, bronze_path, run_key or new_key(), lambda path: {"rows": write(path, "overwrite")})["rows"]


def write_by_validity(df: DataFrame, valid: Column, bronze_path: str, quarantine_path: str, run_key: str | None = None, counts: Callable[[], dict[str, int]] = dict) -> dict[str, int]:
    """Append valid rows to bronze and the others to the quarantine, in one write; returns ``rows``, ``quarantined_rows`` and ``counts()``.

    The rows are staged once, parted by outcome, and each part is published to its table, all under one manifest: both
    tables get the run or neither does. They must lie in one store. The files of both have all columns of ``df``; those
    that only matter to the other table are null.
    """
    cols = schema.BRONZE_PARTITIONS
    outcome = F.when(valid, F.lit(VALID)).otherwise(F.lit(INVALID))

    def write(path: str) -> dict[str, int]:
        seen = Observation("outcomes")
        rows = df.withColumn(_OUTCOME, outcome).observe(
            seen, F.count_if(F.col(_OUTCOME) == VALID).alias("rows"), F.count_if(F.col(_OUTCOME) == INVALID).alias("quarantined_rows")
        )
        _clustered(rows, [_OUTCOME, *cols]).write.mode("overwrite").option("compression", CODEC).partitionBy(_OUTCOME, *cols).parquet(path)
        return {k: int(v) for k, v in seen.get.items()} | counts()

    routes = {f"{_OUTCOME}={VALID}": bronze_path, f"{_OUTCOME}={INVALID}": quarantine_path}
    return append_once(df.sparkSession, bronze_path, run_key or new_key(), write, routes)


def write_silver(df: DataFrame, silver_path: str, dynamic: bool = False, clustered: bool = False) -> int:
    """Overwrite silver, partitioned by year, month and category.

    ``dynamic=True`` replaces only the partitions present in ``df``; use it
    only when ``df`` covers those partitions whole. ``clustered`` rows lie grouped by these columns already.
    """
    cols = schema.SILVER_PARTITIONS
    writer = lambda d: (
        d.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
        .option("compression", CODEC)
        .partitionBy(*cols)
        .parquet(silver_path)
    )
    return observed_write(df if clustered else _clustered(df, cols), writer, "silver")


def write_gold_mart(df: DataFrame, gold_path: str, mart_name: str) -> int:
    """Overwrite ``{gold_path}/{mart_name}``."""
    return observed_write(
        df,
        lambda d: d.write.mode("overwrite").option("compression", CODEC).parquet(f"{gold_path}/{mart_name}"),
        mart_name,
    )


def write_corrupt_records(raw: DataFrame, path: str, mode: str = "append") -> int:
    """Store the lines that did not parse cleanly, with their text.

    All columns are written, so Spark parses every field and flags wrong
    field counts as well as bad values; the stored rows can then be counted
    or filtered like any table.
    """
    return observed_write(
        raw.filter(F.col(schema.CORRUPT_COLUMN).isNotNull()),
        lambda d: d.write.mode(mode).parquet(path),
        "corrupt",
    )
