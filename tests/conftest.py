"""Shared fixtures: a local session and small hand-written order sets."""

from __future__ import annotations

import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from orderlake import schema  # noqa: E402
from orderlake.operators.metadata import add_ingestion_metadata  # noqa: E402
from orderlake.operators.quality import validate_schema  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    session = (
        SparkSession.builder.master("local[4]")
        .appName("orderlake-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    if not session.sparkContext.getCheckpointDir() and not session.conf.get(
        "spark.checkpoint.dir", None
    ):
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="orderlake-test-"))
    yield session
    session.stop()


@pytest.fixture()
def tmp_dir() -> str:
    return tempfile.mkdtemp(prefix="orderlake-run-")


def order(**overrides):
    """A complete, valid raw order; override any field."""
    base = {
        "order_id": "ORD-00000001",
        "customer_id": "CUST-000001",
        "customer_name": "Ana Souza",
        "customer_email": "Ana@Example.com",
        "region": "Sudeste",
        "city": "Campinas",
        "state": "SP",
        "product_id": "PROD-0001",
        "product_name": "Desk Lamp",
        "category": "Home & Garden",
        "quantity": 2,
        "unit_price": 100.0,
        "discount_pct": 10.0,
        "discount_amount": 0.0,
        "gross_revenue": 0.0,
        "net_revenue": 0.0,
        "payment_method": "pix",
        "status": "completed",
        "order_date": "2024-03-10 12:00:00",
        "order_year": 2024,
        "order_month": 3,
        "order_day": 10,
        "created_at": "2024-03-10 12:05:00",
    }
    base.update(overrides)
    return tuple(base[c] for c in schema.RAW_COLUMNS)


def raw_frame(spark, rows):
    return spark.createDataFrame(rows, schema.RAW_SCHEMA)


@pytest.fixture()
def sample_raw(spark):
    """Seven orders: three completed (one customer twice, two discounted),
    one cancelled, one pending plus a later copy of it, one without id."""
    rows = [
        order(order_id="ORD-1", customer_id="CUST-1", quantity=2, unit_price=100.0, discount_pct=10.0),
        order(order_id="ORD-2", customer_id="CUST-1", quantity=1, unit_price=59.9, discount_pct=0.0,
              order_date="2024-04-01 08:00:00", order_month=4, order_day=1, category="BOOKS"),
        order(order_id="ORD-3", customer_id="CUST-2", customer_name="Bruno Lima", region="Sul",
              quantity=5, unit_price=19.99, discount_pct=5.0, status=" Completed ", category="books"),
        order(order_id="ORD-4", customer_id="CUST-3", status="cancelled", discount_pct=20.0),
        order(order_id="ORD-5", customer_id="CUST-4", status="pending", created_at="2024-03-11 00:00:00"),
        order(order_id="ORD-5", customer_id="CUST-4", status="completed", created_at="2024-03-12 00:00:00"),
        order(order_id=None, customer_id="CUST-5"),
    ]
    return raw_frame(spark, rows)


@pytest.fixture()
def sample_bronze(sample_raw):
    return add_ingestion_metadata(
        validate_schema(sample_raw), "s3a://test/landing", "2024-03-15 00:00:00"
    )
