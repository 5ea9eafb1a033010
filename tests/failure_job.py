"""Run by test_failures.py in its own process: a session that retries tasks,
one map task upstream of the ranking failing on its first attempt."""

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from orderlake.operators.ranking import distributed_rank, sort_key, with_ntiles  # noqa: E402
from orderlake.operators.storing import stored_rows  # noqa: E402

spark = (
    SparkSession.builder.master("local[2,4]")
    .config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "4")
    .getOrCreate()
)
spark.sparkContext.setLogLevel("OFF")
spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="orderlake-fail-"))
MARKERS = tempfile.mkdtemp(prefix="orderlake-fail-markers-")


@F.udf("long")
def fail_once(v):
    ctx = TaskContext.get()
    if ctx.partitionId() == 1 and ctx.attemptNumber() == 0:
        open(os.path.join(MARKERS, f"stage{ctx.stageId()}"), "w").close()
        raise RuntimeError("injected task failure")
    return v


base = spark.range(0, 3000, numPartitions=3).select(
    F.col("id"), (F.col("id") % 7).alias("v"), (F.col("id") % 3).cast("string").alias("g")
)
flaky = base.withColumn("v", fail_once("v"))
order = [sort_key("v", "desc"), sort_key("id")]
# The table is stored from tasks that fail, and its scans fail, too: the sample, the counts, the fetch and the result.
stored, rows = stored_rows(flaky.repartition(3), "failing")
again = stored.withColumn("v", fail_once("v"))
tiles = with_ntiles(again, rows, 5, {"t": [(F.col("v"), "desc", "last"), (F.col("id"), "asc", "first")]}, size=64).select("id", "v", "g", "t")
expected = base.withColumn("t", F.ntile(5).over(Window.orderBy(*order)))
ranks = distributed_rank(flaky, ["g"], [("v", "desc")], ["id"], "r", num_partitions=5)
expected_ranks = base.withColumn(
    "r", F.rank().over(Window.partitionBy("g").orderBy(F.col("v").desc_nulls_last()))
)
ok = sorted(tiles.collect()) == sorted(expected.collect()) and sorted(ranks.collect()) == sorted(
    expected_ranks.collect()
)

# Silver built from a bronze whose map tasks fail once equals a clean build.
from orderlake.plans.silver import silver_from_bronze  # noqa: E402
from orderlake.sources.tables import bronze_from_tables  # noqa: E402

bronze = bronze_from_tables(spark, "/root/testdata/sf0.001")
flaky_bronze = bronze.withColumn("quantity", fail_once("quantity").cast("int"))
clean = silver_from_bronze(bronze).drop("_transformed_at").collect()
retried = silver_from_bronze(flaky_bronze).drop("_transformed_at").collect()
ok = ok and len(clean) > 0 and sorted(map(repr, clean)) == sorted(map(repr, retried))
print("RESULT", "OK" if ok else "MISMATCH")
print("FAILED_ATTEMPTS", len(os.listdir(MARKERS)))
