"""Mergeable exact distinct counts, and bronze in buckets."""

import random

import pytest
from pyspark.sql import functions as F

from orderlake.operators.dedup import deduplicate
from orderlake.operators.distinct import distinct_bitmaps, distinct_counts, merged_bitmaps, numbered
from orderlake.operators.metadata import add_ingestion_metadata
from orderlake.sources.bucketed import append_bucketed, bucketed_table
from orderlake.sources.sinks import write_bronze
from tests.conftest import order, raw_frame


def _visits(spark, seed, n, people):
    rng = random.Random(seed)
    rows = [(rng.choice(["a", "b", None]), rng.randint(1, 12), rng.choice([None, f"C{rng.randrange(people)}"])) for _ in range(n)]
    return spark.createDataFrame(rows, "region string, month int, who string")


@pytest.mark.parametrize("n", [0, 1, 3000])
def test_bitmaps_count_as_count_distinct(spark, n):
    df = _visits(spark, n, n, 400)
    by_month = distinct_bitmaps(df, ["region", "month"], "who", numbered(df, "who"))
    for groups in (["region", "month"], ["region"], ["month"], []):
        got = {tuple(r[c] for c in groups): r["u"] for r in distinct_counts(by_month, groups, "u").collect() if r["u"]}
        want = {tuple(r[c] for c in groups): r["u"] for r in df.groupBy(*groups).agg(F.countDistinct("who").alias("u")).collect() if r["u"]}
        assert got == want


def test_numbers_stay_and_months_are_added_without_the_old_rows(spark):
    first, second = _visits(spark, 1, 500, 300), _visits(spark, 2, 500, 600)
    numbers = numbered(first, "who")
    more = numbered(second, "who", numbers)
    old, new = ({r.who: r._number for r in d.collect()} for d in (numbers, more))
    assert old.items() <= new.items() and sorted(new.values()) == list(range(1, len(new) + 1))
    assert {r.who: r._number for r in numbered(second, "who", numbers).collect()} == new
    stored = distinct_bitmaps(first, ["region"], "who", numbers)
    together = merged_bitmaps(stored.unionByName(distinct_bitmaps(second, ["region"], "who", more)), ["region"])
    got = {r.region: r.u for r in distinct_counts(together, ["region"], "u").collect()}
    want = {r.region: r.u for r in first.unionByName(second).groupBy("region").agg(F.countDistinct("who").alias("u")).collect()}
    assert got == want


def test_numbers_beyond_one_bucket(spark):
    df = spark.range(100_000).select(F.concat(F.lit("C"), F.col("id")).alias("who"), (F.col("id") % 2).alias("g"))
    bitmaps = distinct_bitmaps(df, ["g"], "who", numbered(df, "who"))
    assert bitmaps.select("_bucket").distinct().count() == 4
    assert {r.g: r.u for r in distinct_counts(bitmaps, ["g"], "u").collect()} == {0: 50_000, 1: 50_000}


def test_bucketed_bronze_is_deduplicated_without_an_exchange(spark, tmp_dir):
    rows = [order(order_id=f"O{i % 40}", created_at=f"2024-03-{1 + i % 28:02d} 00:00:00", quantity=1 + i % 9) for i in range(200)]
    bronze = add_ingestion_metadata(raw_frame(spark, rows), "s", "2024-01-01 00:00:00")
    path = f"{tmp_dir}/it's a lake"
    for key, part in (("a", bronze.where("quantity < 5")), ("a", bronze), ("b", bronze.where("quantity >= 5"))):
        append_bucketed(part, path, 4, run_key=key)
    table = bucketed_table(spark, path, "bucketed_bronze_test", 4)
    assert table.count() == 200
    latest = deduplicate(table)
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    assert sorted(latest.collect()) == sorted(deduplicate(bronze).select(*latest.columns).collect())
    # Two tables in the same buckets are joined where they lie.
    append_bucketed(bronze.limit(50), f"{tmp_dir}/new", 4)
    new = bucketed_table(spark, f"{tmp_dir}/new", "bucketed_new_test", 4)
    joined = table.hint("merge").join(new.select("order_id"), "order_id", "left_semi")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    # Rows that arrive later are seen after a refresh, and other layouts of the files stay readable.
    append_bucketed(bronze.limit(3), path, 4, run_key="c")
    assert bucketed_table(spark, path, "bucketed_bronze_test", 4).count() == 203
    assert write_bronze(bronze, f"{tmp_dir}/plain") == 200
    for name in ("bucketed_bronze_test", "bucketed_new_test"):
        spark.sql(f"DROP TABLE {name}")


def test_stored_bitmaps_keep_their_numbers_from_load_to_load(spark, tmp_dir):
    from orderlake.plans.jobs import unique_customers, write_customer_bitmaps
    from orderlake.plans.silver import silver_from_bronze
    from orderlake.sources.parquet import read_silver
    from orderlake.sources.sinks import write_silver

    def load(people):
        rows = [order(order_id=f"O{m}{c}{k}", customer_id=f"C{c}", region=f"R{c % 2}", order_month=m, status="completed") for m in (1, 2, 3) for c in people for k in range(2) if (c + m) % 3]
        silver = silver_from_bronze(add_ingestion_metadata(raw_frame(spark, rows), "p", "2024-01-01 00:00:00"))
        write_silver(silver, f"{tmp_dir}/s")
        write_customer_bitmaps(spark, f"{tmp_dir}/s", f"{tmp_dir}/g")
        stored = read_silver(spark, f"{tmp_dir}/s")
        for groups in (["region", "order_year", "order_month"], ["region"], ["order_month"], []):
            want = {tuple(r[c] for c in groups): r["u"] for r in stored.groupBy(*groups).agg(F.countDistinct("customer_id").alias("u")).collect()}
            got = {tuple(r[c] for c in groups): r["unique_customers"] for r in unique_customers(spark, f"{tmp_dir}/g", groups).collect()}
            assert got == want
        numbers = [(r.customer_id, r._number) for r in spark.read.parquet(f"{tmp_dir}/g/customer_numbers").collect()]
        assert sorted(n for _, n in numbers) == list(range(1, len(numbers) + 1))
        return dict(numbers)

    first = load(range(10, 30))
    second = load([*range(5, 25), 40, 41])
    assert first.items() <= second.items() and len(second) == len(first) + 7


def test_buckets_grow_with_the_rows():
    from orderlake.sources.bucketed import ROWS_PER_BUCKET, buckets_for

    assert buckets_for(0, 16) == buckets_for(16 * ROWS_PER_BUCKET, 16) == 16
    assert buckets_for(216 * ROWS_PER_BUCKET + 1, 16) == 217
