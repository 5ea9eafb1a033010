"""Silver as a plan: dedup -> clean -> enrich."""

from __future__ import annotations

from pyspark.sql import DataFrame

from orderlake import schema
from orderlake.functions import initcap_trim
from orderlake.operators.checks import COPY, with_copies
from orderlake.operators.clean import clean_and_standardize
from orderlake.operators.dedup import ROW, deduplicate, rows_in_files, stored_latest
from orderlake.operators.enrich import add_silver_columns


def clustered_raw(bronze: DataFrame) -> DataFrame:
    """Bronze rows grouped as silver is partitioned, by the category that they will be cleaned to."""
    year, month, category = schema.SILVER_PARTITIONS
    return bronze.withColumn("_cleaned", initcap_trim(category)).hint("rebalance", year, month, "_cleaned").drop("_cleaned")


def silver_from_bronze(
    bronze: DataFrame, null_bucket: str | None = "premium", mark_copies: bool = False, stored: bool = False, grouped: bool = False
) -> DataFrame:
    """Deduplicated, cleaned and enriched orders.

    ``mark_copies`` keeps a mark on rows that share an order id, for the rules counted while silver is written. ``stored`` is for rows
    that are written right away: bronze is stored once and its full rows move once, to their silver partitions, before they
    are cleaned and so grow; write them with ``clustered=True``. ``grouped`` says that bronze's scan has few order months in each task: then
    full rows don't move at all.
    """
    if stored:
        latest = stored_latest(bronze, copies=COPY if mark_copies else None)
        latest = latest if grouped else clustered_raw(latest)
    else:
        latest = deduplicate(bronze)
        latest = with_copies(latest, "silver") if mark_copies else latest
    return _cleaned(latest, null_bucket)


def silver_from_files(bronze: DataFrame, grouped: bool) -> tuple[DataFrame, int]:
    """:func:`silver_from_bronze` with marks, for bronze read from its layer and silver that is written right away; and bronze's rows.

    Bronze's files are read twice instead of being stored a second time.
    """
    found = rows_in_files(bronze)
    latest = found.latest(copies=COPY).drop(ROW)
    return _cleaned(latest if grouped else clustered_raw(latest)), found.count


def _cleaned(latest: DataFrame, null_bucket: str | None = "premium") -> DataFrame:
    return add_silver_columns(clean_and_standardize(latest), null_bucket=null_bucket)
