from pyspark.sql import functions as F

from orderlake.operators.metadata import add_ingestion_metadata
from orderlake.operators.quality import quarantined_orders, validate_schema, validation_report
from tests.conftest import order, raw_frame


def test_null_required_ids_are_removed(sample_raw):
    valid = validate_schema(sample_raw)
    assert valid.filter(F.col("order_id").isNull()).count() == 0
    assert valid.count() == 6


def test_empty_string_passes_validation(spark):
    df = raw_frame(spark, [order(customer_id=""), order(product_id=None)])
    assert validate_schema(df).count() == 1


def test_quarantine_is_the_complement_with_reasons(spark):
    df = raw_frame(spark, [order(), order(order_id=None, product_id=None), order(customer_id=None)])
    q = quarantined_orders(df).orderBy("customer_id").collect()
    assert len(q) == 2
    reasons = sorted(tuple(r["_quarantine_reasons"]) for r in q)
    assert reasons == [("customer_id is null",), ("order_id is null", "product_id is null")]


def test_validation_report_counts(sample_raw):
    r = validation_report(sample_raw).first()
    assert (r.total_rows, r.valid_rows, r.invalid_rows, r.null_order_id) == (7, 6, 1, 1)


def test_metadata_columns_and_run_id(sample_raw):
    out = add_ingestion_metadata(validate_schema(sample_raw), "s3a://x/y", "2024-05-06 07:08:09")
    row = out.select("_ingested_at", "_source_path", "_pipeline_run_id").first()
    assert str(row._ingested_at) == "2024-05-06 07:08:09"
    assert row._source_path == "s3a://x/y"
    assert row._pipeline_run_id == "2024-05-06T070809"
    assert out.count() == 6


def test_metadata_default_time_is_one_value_per_run(sample_raw):
    out = add_ingestion_metadata(sample_raw, "p")
    assert out.select("_ingested_at").distinct().count() == 1
    assert out.filter(F.col("_pipeline_run_id").isNull()).count() == 0
