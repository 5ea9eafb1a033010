"""Plan shapes that matter at scale: skewed keys must not land in one task."""

import glob

from pyspark.sql import functions as F

from orderlake import schema
from orderlake.operators.dedup import deduplicate
from orderlake.operators.metadata import add_ingestion_metadata
from orderlake.sources.sinks import write_silver
from orderlake.plans.silver import silver_from_bronze
from tests.conftest import order


def _hot_bronze(spark, n):
    # nine rows in ten are copies of one order, all in one partition value
    values = dict(zip(schema.RAW_COLUMNS, order()))
    types = {f.name: f.dataType for f in schema.RAW_SCHEMA.fields}
    rows = spark.range(n).select(
        *[
            (F.col("id") % 50 + 1).cast("int").alias(c)
            if c == "quantity"
            else F.when(F.col("id") % 10 == 0, F.format_string("ORD-%d", F.col("id")))
            .otherwise(F.lit("ORD-HOT")).alias(c)
            if c == "order_id"
            else F.lit(values[c]).cast(types[c]).alias(c)
            for c in schema.RAW_COLUMNS
        ]
    )
    return add_ingestion_metadata(rows, "p", "2024-01-01 00:00:00")


def test_dedup_limits_each_key_before_the_shuffle(spark):
    bronze = _hot_bronze(spark, 1000).repartition(8)
    out = deduplicate(bronze)
    plan = out._jdf.queryExecution().executedPlan().toString()
    partial = plan.index("WindowGroupLimit")
    assert "Partial" in plan and "Final" in plan
    # the partial limit sits below (after, in text) the hashpartitioning exchange
    assert plan.index("Exchange hashpartitioning(order_id") < plan.rindex("WindowGroupLimit")
    assert partial >= 0
    assert out.count() == 101


def test_hot_partition_value_is_written_by_several_tasks(spark, tmp_dir):
    # A rebalance splits a large partition value along map outputs; keep the
    # small test input in several map tasks, as a large input would be.
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        silver = silver_from_bronze(_hot_bronze(spark, 20000).withColumn(
            "order_id", F.concat(F.lit("ORD-"), F.monotonically_increasing_id().cast("string"))
        ))
        write_silver(silver, f"{tmp_dir}/silver")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = glob.glob(f"{tmp_dir}/silver/order_year=2024/order_month=3/category=*/*.parquet")
    assert len(files) > 1
