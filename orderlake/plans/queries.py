"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query starts from the given order tables, so its work grows with
them. Wall-clock columns (``_transformed_at``, ``_created_at``) are left
out, and decimals are reported as doubles, so results can be compared
with :mod:`orderlake.plans.oracle`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake import schema
from orderlake.functions import report_doubles
from orderlake.operators.dedup import deduplicate, duplicates_removed
from orderlake.operators.clean import clean_and_standardize
from orderlake.operators.marts import (
    build_customer_segments,
    build_product_performance,
    build_sales_by_region,
    completed_orders,
    rfm_base,
    rfm_scores,
    segment_distribution,
    top_products_by_category,
    with_recency,
)
from orderlake.operators.metadata import add_ingestion_metadata
from orderlake.operators.storing import stored_rows
from orderlake.operators.quality import (
    quarantined_orders,
    validate_schema,
    validation_report,
)
from orderlake.plans.jobs import run_ingestion, run_load, run_transformation, unique_customers, validate_layers, write_customer_bitmaps
from orderlake.plans.pipeline import LayerPaths, run_pipeline
from orderlake.plans.silver import silver_from_bronze
from orderlake.session import DROP_SHUFFLES, GROUPED, owned_scratch, scratch_path, session_conf
from orderlake.sources.bucketed import append_bucketed, bucketed_table, buckets_for
from orderlake.sources.csv import ROWS_PER_FILE, read_raw_csv, write_raw_csv
from orderlake.sources.parquet import read_bronze, read_quarantine, read_silver
from orderlake.sources.sinks import write_bronze, write_corrupt_records, write_silver
from orderlake.sources.synthetic import synthetic_orders
from orderlake.sources.tables import bronze_from_tables, raw_orders_from_tables
from orderlake.streaming.ingest import ingest_new_files

Query = Callable[[SparkSession, str], DataFrame]

FIXED_RUN_TIME = "2024-01-01 00:00:00"
FIXED_SOURCE = "s3a://landing/sales/*.csv"
TOP_K = 10
BUCKETS = 16
#: How the queries that run the jobs land their raw files.
LANDED = "gzip"


def _bronze(spark: SparkSession, d: str) -> DataFrame:
    return bronze_from_tables(spark, d)


def _stored_bronze(spark: SparkSession, d: str) -> DataFrame:
    """Bronze rows for queries that write them in several runs: made once, and grouped by month as bronze is partitioned."""
    with session_conf(spark, DROP_SHUFFLES):
        return stored_rows(bronze_from_tables(spark, d, by_month=True), "bronze-rows")[0]


def _land(spark: SparkSession, d: str, folder: str) -> None:
    """Raw files for the jobs, each of a few order months, as files that come in day by day are."""
    with session_conf(spark, DROP_SHUFFLES):
        write_raw_csv(raw_orders_from_tables(spark, d, by_month=True), folder, compression=LANDED)


def _silver(spark: SparkSession, d: str) -> DataFrame:
    return silver_from_bronze(_bronze(spark, d))


def _completed(spark: SparkSession, d: str) -> DataFrame:
    return completed_orders(_silver(spark, d))


def _no_clock(df: DataFrame) -> DataFrame:
    return report_doubles(df.drop("_transformed_at", "_created_at"))


def csv_scan(spark, d):
    landing = scratch_path(spark, "landing")
    write_raw_csv(raw_orders_from_tables(spark, d), landing)
    return read_raw_csv(spark, f"{landing}/*.csv", keep_corrupt=False)


def csv_corrupt_records(spark, d):
    landing = scratch_path(spark, "landing-lines")
    lines = render_csv_lines(raw_orders_from_tables(spark, d))
    with session_conf(spark, DROP_SHUFFLES):
        lines.write.option("compression", LANDED).option("maxRecordsPerFile", ROWS_PER_FILE).text(landing)
    raw = read_raw_csv(spark, landing, header=False)
    stored = scratch_path(spark, "corrupt")
    write_corrupt_records(raw, stored)
    return spark.read.schema(raw.schema).parquet(stored)


def valid_orders(spark, d):
    return validate_schema(raw_orders_from_tables(spark, d))


def quarantined(spark, d):
    q = quarantined_orders(raw_orders_from_tables(spark, d))
    return q.withColumn(
        "_quarantine_reasons", F.array_join("_quarantine_reasons", "; ")
    )


def validation(spark, d):
    return validation_report(raw_orders_from_tables(spark, d))


def ingestion_metadata(spark, d):
    valid = validate_schema(raw_orders_from_tables(spark, d))
    return add_ingestion_metadata(valid, FIXED_SOURCE, FIXED_RUN_TIME)


def bronze_roundtrip(spark, d):
    path = scratch_path(spark, "bronze")
    write_bronze(bronze_from_tables(spark, d, by_month=True), path, clustered=True)
    return read_bronze(spark, path)


def bronze_append_rerun(spark, d):
    path = scratch_path(spark, "bronze")
    rows = _stored_bronze(spark, d)
    for _ in range(2):
        write_bronze(rows, path, clustered=True)
    return read_bronze(spark, path)


def dedupe_latest(spark, d):
    return deduplicate(_bronze(spark, d))


def dedupe_removed(spark, d):
    return duplicates_removed(_bronze(spark, d))


def clean_orders(spark, d):
    return report_doubles(clean_and_standardize(deduplicate(_bronze(spark, d))))


def recomputed_financials(spark, d):
    clean = clean_and_standardize(deduplicate(_bronze(spark, d)))
    return report_doubles(
        clean.select(
            "order_id", "quantity", "unit_price", "discount_pct",
            "gross_revenue", "discount_amount", "net_revenue",
        )
    )


def silver_columns(spark, d):
    return _no_clock(_silver(spark, d))


def revenue_buckets(spark, d):
    return report_doubles(
        _silver(spark, d)
        .groupBy("revenue_bucket")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.count("net_revenue").alias("priced_orders"),
            F.min("net_revenue").alias("min_net_revenue"),
            F.max("net_revenue").alias("max_net_revenue"),
        )
    )


def _write_silver_of_tables(spark, d, path: str) -> None:
    """Silver of the tables' rows. They are grouped by month while they are narrow, and then stay where they are."""
    with owned_scratch(spark), session_conf(spark, DROP_SHUFFLES):
        silver = silver_from_bronze(bronze_from_tables(spark, d, by_month=True), stored=True, grouped=True)
        with session_conf(spark, GROUPED):
            write_silver(silver, path, clustered=True)


def _written_silver(spark, d) -> str:
    path = scratch_path(spark, "silver")
    _write_silver_of_tables(spark, d, path)
    return path


def silver_orders(spark, d):
    return _no_clock(read_silver(spark, _written_silver(spark, d), completed_only=False))


def silver_partition_counts(spark, d):
    silver = read_silver(spark, _written_silver(spark, d), completed_only=False)
    return silver.groupBy(*schema.SILVER_PARTITIONS).agg(F.count(F.lit(1)).alias("rows"))


def completed(spark, d):
    return _no_clock(read_silver(spark, _written_silver(spark, d), completed_only=True))


def sales_by_region(spark, d):
    return _no_clock(build_sales_by_region(_completed(spark, d)))


def product_performance(spark, d):
    return _no_clock(build_product_performance(_completed(spark, d)))


def top_products(spark, d):
    return _no_clock(
        top_products_by_category(build_product_performance(_completed(spark, d)), TOP_K)
    )


def rfm_base_query(spark, d):
    return _no_clock(with_recency(rfm_base(_completed(spark, d))))


def rfm_scores_query(spark, d):
    return _no_clock(rfm_scores(rfm_base(_completed(spark, d))))


def customer_segments(spark, d):
    return _no_clock(build_customer_segments(_completed(spark, d)))


def customer_segments_standard(spark, d):
    return _no_clock(build_customer_segments(_completed(spark, d), scoring="standard"))


def segments_histogram(spark, d):
    return segment_distribution(build_customer_segments(_completed(spark, d)))


def _layer_paths(spark) -> LayerPaths:
    root = scratch_path(spark, "lake")
    return LayerPaths(
        source=f"{root}/landing/*.csv.gz",
        bronze=f"{root}/bronze",
        silver=f"{root}/silver",
        gold=f"{root}/gold",
    )


def mart_roundtrip(spark, d):
    paths = _layer_paths(spark)
    _write_silver_of_tables(spark, d, paths.silver)
    run_load(spark, paths.silver, paths.gold)
    marts = ["sales_by_region", "product_performance", "customer_segments"]
    counts = [
        spark.read.parquet(f"{paths.gold}/{m}").agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(m).alias("mart"), "rows")
        for m in marts
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


def _run_all(spark, d) -> dict:
    paths = _layer_paths(spark)
    _land(spark, d, paths.source.rsplit("/", 1)[0])
    return run_pipeline(spark, None, paths, ingested_at=FIXED_RUN_TIME, landed_by_month=True)


def pipeline_run(spark, d):
    res = _run_all(spark, d)
    rows = [
        ("ingestion", "bronze", res["ingestion"]["records"]),
        ("transformation", "silver", res["transformation"]["records"]),
    ] + [("load", m, n) for m, n in res["load"]["metrics"].items()]
    return spark.createDataFrame(rows, "step string, output string, records long")


def layer_counts(spark, d):
    res = _run_all(spark, d)
    ing, tr = res["ingestion"]["metrics"], res["transformation"]["metrics"]
    rows = [
        ("raw", "read_rows", ing["read_rows"]),
        ("raw", "corrupt_rows", ing["corrupt_rows"]),
        ("raw", "invalid_rows", ing["invalid_rows"]),
        ("bronze", "written_rows", res["ingestion"]["records"]),
        ("bronze", "duplicates_removed", tr["duplicates_removed"]),
        ("silver", "written_rows", res["transformation"]["records"]),
    ] + [(f"gold.{m}", "written_rows", n) for m, n in res["load"]["metrics"].items()]
    return spark.createDataFrame(rows, "layer string, metric string, value long")


def layer_checks(spark, d):
    paths = _layer_paths(spark)
    _land(spark, d, paths.source.rsplit("/", 1)[0])
    run_pipeline(spark, None, paths, ingested_at=FIXED_RUN_TIME, landed_by_month=True)
    return validate_layers(spark, paths.bronze, paths.silver, paths.gold)


def _stored_lake(spark, d) -> LayerPaths:
    paths = _layer_paths(spark)
    _land(spark, d, paths.source.rsplit("/", 1)[0])
    run_pipeline(spark, None, paths, ingested_at=FIXED_RUN_TIME, landed_by_month=True)
    return paths


def stored_silver(spark, d):
    """What the jobs store as silver, from landed files."""
    stored = read_silver(spark, _stored_lake(spark, d).silver, completed_only=False)
    return _no_clock(stored).drop("_ingested_at", "_source_path", "_pipeline_run_id")


def _stored_mart(name: str) -> Query:
    def query(spark, d):
        return _no_clock(spark.read.parquet(f"{_stored_lake(spark, d).gold}/{name}"))

    return query


def stream_ingest(spark, d):
    """File-stream ingestion run twice over the same landed files: the second
    run finds nothing new, so bronze holds each valid row once. Metadata
    columns carry the batch time and are left out."""
    root = scratch_path(spark, "stream")
    write_raw_csv(raw_orders_from_tables(spark, d), f"{root}/landing", compression=LANDED)
    for _ in range(2):
        ingest_new_files(spark, f"{root}/landing", f"{root}/bronze", f"{root}/checkpoint")
    return read_bronze(spark, f"{root}/bronze").drop(*schema.METADATA_COLUMNS)


def _arrivals(spark, d, parts: int):
    """Bronze rows dealt to several runs, so that copies of an order arrive in different ones."""
    bronze = _stored_bronze(spark, d)
    for i in range(parts):
        yield f"run-{i}", bronze.where(F.coalesce(F.pmod(F.xxhash64("quantity", "created_at"), F.lit(parts)), F.lit(0)) == i)


def bronze_commits(spark, d):
    """Bronze appended in three runs, each of them twice under its key."""
    path = scratch_path(spark, "bronze")
    for key, rows in _arrivals(spark, d, 3):
        for _ in range(2):
            write_bronze(rows, path, run_key=key, clustered=True)
    return read_bronze(spark, path)


def stored_quarantine(spark, d):
    """What ingestion stores of invalid rows, split off while the source is read once."""
    root = scratch_path(spark, "quarantine")
    write_raw_csv(raw_orders_from_tables(spark, d), f"{root}/landing", compression=LANDED)
    run_ingestion(spark, f"{root}/landing/*.csv.gz", f"{root}/bronze", FIXED_RUN_TIME, quarantine_path=f"{root}/quarantine")
    stored = read_quarantine(spark, f"{root}/quarantine").drop(*schema.METADATA_COLUMNS, schema.CORRUPT_COLUMN)
    return stored.withColumn(schema.REASONS_COLUMN, F.array_join(schema.REASONS_COLUMN, "; "))


def incremental_silver(spark, d):
    """Silver merged run by run while bronze grows."""
    root = scratch_path(spark, "incremental")
    for key, rows in _arrivals(spark, d, 3):
        write_bronze(rows, f"{root}/bronze", run_key=key, clustered=True)
        run_transformation(spark, f"{root}/bronze", f"{root}/silver", incremental=True)
    return _no_clock(read_silver(spark, f"{root}/silver", completed_only=False))


def bucketed_dedupe(spark, d):
    """Deduplication of bronze that is stored in buckets by order id, appended in three runs."""
    path = scratch_path(spark, "bucketed")
    # Line items become a bronze row each; their count is in the files' footers.
    buckets = buckets_for(spark.read.parquet(f"{d}/lineitem.parquet").count(), BUCKETS)
    for key, rows in _arrivals(spark, d, 3):
        append_bucketed(rows, path, buckets, run_key=key)
    return deduplicate(bucketed_table(spark, path, f"bronze_{uuid.uuid4().hex}", buckets))


def unique_customers_query(spark, d):
    """Distinct customers of completed orders by region and year, and over all regions, merged from stored bitmaps by month."""
    root = scratch_path(spark, "customers")
    _write_silver_of_tables(spark, d, f"{root}/silver")
    write_customer_bitmaps(spark, f"{root}/silver", f"{root}/gold")
    by_region = unique_customers(spark, f"{root}/gold", ["region", "order_year"])
    overall = unique_customers(spark, f"{root}/gold", ["order_year"]).withColumn("region", F.lit("(all)"))
    return by_region.unionByName(overall)


def synthetic(spark, d):
    ids = spark.read.parquet(f"{d}/lineitem.parquet").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id")
    )
    return synthetic_orders(ids)


def render_csv_lines(raw: DataFrame) -> DataFrame:
    """Raw rows as CSV text lines, some deliberately malformed.

    Strings are quoted, doubles written with two decimals, nulls left
    empty. Depending on day and quantity a line gets text in the quantity
    field, loses its last two fields, gains an extra field, or loses its
    customer id (then it is valid CSV but fails validation).
    """
    def field(c: str):
        dtype = dict(raw.dtypes)[c]
        col = F.col(c)
        if dtype == "string":
            text = F.concat(F.lit('"'), F.replace(col, F.lit('"'), F.lit('""')), F.lit('"'))
        elif dtype == "double":
            text = F.format_string("%.2f", col)
        else:
            text = col.cast("string")
        return F.coalesce(text, F.lit(""))

    kind = F.when(
        (F.col("order_day") % 10) == (F.col("quantity") % 10),
        F.col("order_day") % 10,
    ).otherwise(F.lit(0))
    cols = schema.RAW_COLUMNS
    fields = {c: field(c) for c in cols}
    fields["quantity"] = F.when(
        kind == 1, F.concat(F.lit('"qty'), F.col("quantity").cast("string"), F.lit('"'))
    ).otherwise(fields["quantity"])
    fields["customer_id"] = F.when(kind == 4, F.lit("")).otherwise(fields["customer_id"])
    full = F.concat_ws(",", *[fields[c] for c in cols])
    short = F.concat_ws(",", *[fields[c] for c in cols[:-2]])
    line = (
        F.when(kind == 2, short)
        .when(kind == 3, F.concat(full, F.lit(',"extra"')))
        .otherwise(full)
    )
    return raw.select(line.alias("value"))


REGISTRY: dict[str, Query] = {
    "csv_scan": csv_scan,
    "csv_corrupt_records": csv_corrupt_records,
    "valid_orders": valid_orders,
    "quarantined_orders": quarantined,
    "validation_report": validation,
    "ingestion_metadata": ingestion_metadata,
    "bronze_roundtrip": bronze_roundtrip,
    "bronze_append_rerun": bronze_append_rerun,
    "dedupe_latest": dedupe_latest,
    "dedupe_removed": dedupe_removed,
    "clean_orders": clean_orders,
    "recomputed_financials": recomputed_financials,
    "silver_columns": silver_columns,
    "revenue_buckets": revenue_buckets,
    "silver_orders": silver_orders,
    "silver_partition_counts": silver_partition_counts,
    "completed_orders": completed,
    "sales_by_region": sales_by_region,
    "product_performance": product_performance,
    "top_products_by_category": top_products,
    "rfm_base": rfm_base_query,
    "rfm_scores": rfm_scores_query,
    "customer_segments": customer_segments,
    "customer_segments_standard": customer_segments_standard,
    "segment_distribution": segments_histogram,
    "mart_roundtrip": mart_roundtrip,
    "pipeline_run": pipeline_run,
    "layer_counts": layer_counts,
    "layer_checks": layer_checks,
    "stream_ingest": stream_ingest,
    "synthetic_orders": synthetic,
    "bronze_commits": bronze_commits,
    "stored_quarantine": stored_quarantine,
    "incremental_silver": incremental_silver,
    "bucketed_dedupe": bucketed_dedupe,
    "unique_customers": unique_customers_query,
    "stored_silver": stored_silver,
    **{f"stored_{m}": _stored_mart(m) for m in ("sales_by_region", "product_performance", "customer_segments")},
}
