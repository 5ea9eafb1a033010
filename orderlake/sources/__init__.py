"""Readers and writers."""

from orderlake.sources.commits import append_once, committed, recover
from orderlake.sources.csv import corrupt_records, read_raw_csv, write_raw_csv
from orderlake.sources.inventory import file_inventory
from orderlake.sources.parquet import read_bronze, read_quarantine, read_silver
from orderlake.sources.sinks import write_bronze, write_corrupt_records, write_gold_mart, write_silver
from orderlake.sources.tables import bronze_from_tables, raw_orders_from_tables

__all__ = [
    "append_once",
    "bronze_from_tables",
    "committed",
    "corrupt_records",
    "file_inventory",
    "raw_orders_from_tables",
    "read_bronze",
    "read_quarantine",
    "read_raw_csv",
    "read_silver",
    "recover",
    "write_bronze",
    "write_corrupt_records",
    "write_gold_mart",
    "write_raw_csv",
    "write_silver",
]
