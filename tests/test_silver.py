import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderlake.operators.clean import clean_and_standardize
from orderlake.operators.dedup import deduplicate, duplicates_removed
from orderlake.operators.enrich import add_silver_columns
from orderlake.operators.metadata import add_ingestion_metadata
from tests.conftest import order, raw_frame


def _bronze(spark, rows, at="2024-01-01 00:00:00"):
    return add_ingestion_metadata(raw_frame(spark, rows), "p", at)


def _clean_one(spark, **overrides):
    return clean_and_standardize(_bronze(spark, [order(**overrides)])).first()


def test_dedup_keeps_latest_created_within_a_run(sample_bronze):
    out = deduplicate(sample_bronze)
    assert out.count() == 5
    assert out.select("order_id").distinct().count() == 5
    kept = out.filter(F.col("order_id") == "ORD-5").first()
    assert kept.status == "completed"


def test_dedup_prefers_later_ingestion_run(spark):
    first = _bronze(spark, [order(status="pending", created_at="2024-09-09 00:00:00")], "2024-01-01 00:00:00")
    second = _bronze(spark, [order(status="cancelled", created_at="2024-01-01 00:00:00")], "2024-02-01 00:00:00")
    out = deduplicate(first.unionByName(second)).collect()
    assert [r.status for r in out] == ["cancelled"]


def test_dedup_is_deterministic_on_full_ties(spark):
    rows = [order(quantity=q) for q in (7, 3, 5)]
    for _ in range(3):
        out = deduplicate(_bronze(spark, rows)).collect()
        assert [r.quantity for r in out] == [3]


def test_duplicates_removed_is_the_complement(sample_bronze):
    removed = duplicates_removed(sample_bronze).collect()
    assert [(r.order_id, r.status) for r in removed] == [("ORD-5", "pending")]


def test_duplicates_removed_keeps_exact_copies(spark):
    rows = [order(), order(), order(), order(quantity=9)]
    bronze = _bronze(spark, rows)
    assert deduplicate(bronze).count() == 1
    removed = duplicates_removed(bronze).collect()
    assert sorted(r.quantity for r in removed) == [2, 2, 9]


@pytest.mark.parametrize("qty,expected", [(0, None), (1, 1), (100, 100), (101, None), (None, None)])
def test_quantity_range_nulls_outside(spark, qty, expected):
    assert _clean_one(spark, quantity=qty).quantity == expected


@pytest.mark.parametrize("price", [0.0, -1.0, None, float("nan"), float("inf"), 1e15])
def test_bad_prices_become_null(spark, price):
    row = _clean_one(spark, unit_price=price)
    assert row.unit_price is None
    assert row.gross_revenue is None and row.net_revenue is None


@pytest.mark.parametrize("status,expected", [(" Completed ", "completed"), ("shipped", None), (None, None), ("\tpending", None)])
def test_status_domain(spark, status, expected):
    assert _clean_one(spark, status=status).status == expected


@pytest.mark.parametrize("cat,expected", [("home & garden", "Home & Garden"), ("FOOD & BEVERAGES", "Food & Beverages"), ("  books ", "Books"), ("x-y", "X-y")])
def test_category_title_case(spark, cat, expected):
    assert _clean_one(spark, category=cat).category == expected


@pytest.mark.parametrize("text", ["nope", "2024-01-01", None, "2024-02-30 00:00:00"])
def test_unparsable_dates_become_null(spark, text):
    assert _clean_one(spark, order_date=text).order_date is None


def test_text_fields_normalised(spark):
    row = _clean_one(spark, customer_email="  Ana@EXAMPLE.com ", payment_method=" PIX", region=" Sul ")
    assert (row.customer_email, row.payment_method, row.region) == ("ana@example.com", "pix", "Sul")


def test_financials_recomputed_exactly(spark):
    row = _clean_one(spark, quantity=2, unit_price=266.15, discount_pct=15.0, gross_revenue=1.0, net_revenue=1.0)
    assert row.gross_revenue == Decimal("532.30")
    assert row.discount_amount == Decimal("79.85")  # half cent rounds up
    assert row.net_revenue == Decimal("452.45")


def test_null_discount_gives_null_net_and_premium_bucket(spark):
    silver = add_silver_columns(clean_and_standardize(_bronze(spark, [order(discount_pct=None)]))).first()
    assert silver.net_revenue is None
    assert silver.is_discounted is None
    assert silver.revenue_bucket == "premium"


def test_null_bucket_option(spark):
    df = clean_and_standardize(_bronze(spark, [order(discount_pct=None)]))
    assert add_silver_columns(df, null_bucket=None).first().revenue_bucket is None


@pytest.mark.parametrize(
    "net,bucket",
    [(99.99, "low"), (100.0, "medium"), (499.99, "medium"), (500.0, "high"), (1999.99, "high"), (2000.0, "premium")],
)
def test_bucket_bounds(spark, net, bucket):
    silver = add_silver_columns(
        clean_and_standardize(_bronze(spark, [order(quantity=1, unit_price=net, discount_pct=0.0)]))
    ).first()
    assert silver.revenue_bucket == bucket


@pytest.mark.parametrize("date,week,quarter", [("2024-12-30 10:00:00", 1, 4), ("2021-01-01 00:00:00", 53, 1)])
def test_iso_week_and_quarter(spark, date, week, quarter):
    silver = add_silver_columns(clean_and_standardize(_bronze(spark, [order(order_date=date)]))).first()
    assert (silver.order_week, silver.order_quarter) == (week, quarter)
    assert silver.order_date == dt.datetime.strptime(date, "%Y-%m-%d %H:%M:%S")


def test_duplicates_removed_spreads_large_copy_groups(spark):
    # 25 exact copies of one order and one variant: 24 copies + the variant go
    rows = [order()] * 25 + [order(quantity=9), order(order_id=None), order(order_id=None), order(order_id="ONE")]
    bronze = _bronze(spark, rows).repartition(3)
    out = duplicates_removed(bronze)
    assert sorted(r.quantity for r in out.where("order_id IS NOT NULL").collect()) == [2] * 24 + [9]
    kept = deduplicate(bronze)
    assert sorted(map(repr, out.collect())) == sorted(map(repr, bronze.exceptAll(kept).collect()))
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # Only the survivors' side meets by key, cut to one row a task before; the rows themselves don't.
    assert "WindowGroupLimit" in plan and plan.count("hashpartitioning(order_id") <= 1


def test_latest_rows_are_found_without_moving_full_rows(spark):
    from orderlake.operators.dedup import stored_latest

    # Ties of arrival, null arrivals and ids, copies, and a key whose latest row is not its first by the other columns.
    rows = [order(), order(), order(quantity=9), order(order_id=None), order(order_id=None, quantity=3), order(order_id="ONE")]
    rows += [order(order_id="LATE", created_at=c, quantity=q) for c, q in ((None, 1), ("2024-03-02 10:00:00", 7), ("2024-03-01 10:00:00", 2))]
    rows += [order(order_id=f"N{i % 700}", quantity=i % 9, created_at=None if i % 5 == 0 else f"2024-03-0{i % 4 + 1} 10:00:00") for i in range(2000)]
    bronze = _bronze(spark, rows).repartition(5)
    out = stored_latest(bronze, copies="_copy")
    assert not out.where("_copy").count()
    assert sorted(map(repr, out.drop("_copy").collect())) == sorted(map(repr, deduplicate(bronze).collect()))
    plan = stored_latest(bronze.where("order_id <> 'ONE'")).drop("_copy")._jdf.queryExecution().optimizedPlan().toString()
    # Rows are kept by their bits: no window and no sort over full rows but those of tied keys.
    assert plan.count("Window ") == 1 and "bitmap_construct_agg" in plan
