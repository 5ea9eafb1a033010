"""Early deletion of shuffle files."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row

from orderlake.session import DROP_SHUFFLES, session_conf


def write_and_drop_shuffles(df: DataFrame, path: str) -> None:
    """Write ``df`` as Parquet; the shuffle files of the write are deleted when it ends.

    By itself Spark deletes them when the driver collects its garbage, which a driver with little to do may not for hours. So the
    disk never holds the shuffles of two steps.
    """
    with session_conf(df.sparkSession, DROP_SHUFFLES):
        df.write.parquet(path)


def collect_and_drop_shuffles(df: DataFrame) -> list[Row]:
    """The rows of ``df``, which are few; the shuffle files behind them are deleted, as by :func:`write_and_drop_shuffles`."""
    with session_conf(df.sparkSession, DROP_SHUFFLES):
        return df.select("*").collect()
