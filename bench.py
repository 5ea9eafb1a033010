"""Benchmark the headline queries.

Runs each query to completion with the ``noop`` sink (full execution, no
collection on the driver) on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR``,
one warm-up then the median of ``$BENCH_RUNS`` timed runs, and prints one
JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from orderlake.functions import report_doubles  # noqa: E402
from orderlake.operators import marts as M  # noqa: E402
from orderlake.plans import queries as Q  # noqa: E402
from orderlake.plans.pipeline import LayerPaths, run_pipeline  # noqa: E402
from orderlake.plans.silver import silver_from_bronze  # noqa: E402
from orderlake.session import clear_scratch, get_session, scratch_path  # noqa: E402
from orderlake.sources.csv import write_raw_csv  # noqa: E402
from orderlake.sources.tables import bronze_from_tables, raw_orders_from_tables  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
#: The line items are one row group: without dealing them out one task would read and join them all.
SCAN_TASKS = int(os.environ.get("BENCH_SCAN_TASKS", CPUS))
SHUFFLE = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", CPUS))


def _noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = get_session(
        "orderlake-bench",
        master=f"local[{CPUS}]",
        conf={
            "spark.sql.shuffle.partitions": str(SHUFFLE),
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    landing = scratch_path(spark, "bench-landing")
    write_raw_csv(raw_orders_from_tables(spark, SF_DIR), landing)

    def pipeline() -> None:
        root = scratch_path(spark, "bench-lake")
        paths = LayerPaths(f"{landing}/*.csv", f"{root}/bronze", f"{root}/silver", f"{root}/gold")
        run_pipeline(spark, None, paths, ingested_at=Q.FIXED_RUN_TIME)

    def silver():
        return silver_from_bronze(bronze_from_tables(spark, SF_DIR, SCAN_TASKS or None))

    def mart(build) -> None:
        # As the registered queries: from the tables, reported as doubles.
        _noop(report_doubles(build(M.completed_orders(silver())).drop("_created_at")))

    jobs = {
        "silver_from_tables": lambda: _noop(report_doubles(silver().drop("_transformed_at"))),
        "sales_by_region": lambda: mart(M.build_sales_by_region),
        "product_performance": lambda: mart(M.build_product_performance),
        "customer_segments": lambda: mart(M.build_customer_segments),
        "pipeline_csv_to_gold": pipeline,
    }
    medians = {}
    for name, job in jobs.items():
        job()  # warm-up
        times = []
        for _ in range(RUNS):
            start = time.perf_counter()
            job()
            times.append(time.perf_counter() - start)
        medians[name] = round(statistics.median(times), 3)
    sf = re.search(r"sf([0-9.]+)", SF_DIR)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total_median",
                "value": round(sum(medians.values()), 3),
                "unit": "sec",
                "queries": medians,
                "sf": float(sf.group(1)) if sf else SF_DIR,
                "cpus": CPUS,
                "shuffle_partitions": SHUFFLE,
                "runs": RUNS,
                "scan_tasks": SCAN_TASKS,
            }
        )
    )
    clear_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
