"""Print the physical plans of the main operators (for PLANS.md).

Usage: python tools/show_plans.py [sf_dir]
Silver is written once from the tables into a scratch folder, then each
operator is planned the way the load job runs it (reading silver).
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from orderlake import schema  # noqa: E402
from orderlake.operators import marts as M  # noqa: E402
from orderlake.operators.dedup import deduplicate, duplicates_removed  # noqa: E402
from orderlake.plans.queries import _bronze, _silver  # noqa: E402
from orderlake.session import get_session, scratch_path  # noqa: E402
from orderlake.sources.parquet import read_silver  # noqa: E402
from orderlake.sources.sinks import write_silver  # noqa: E402


def plan(df) -> str:
    text = df._jdf.queryExecution().executedPlan().toString()
    # Splitters are long literals: only that they are there matters here.
    return re.sub(r"\[\[.{200,}?\]\]", "[[splitters]]", text.split("== Initial Plan ==")[0]).rstrip()


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session(master="local[8]", conf={"spark.sql.shuffle.partitions": "16", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    path = scratch_path(spark, "plans-silver")
    write_silver(_silver(spark, sf_dir), path)
    done = read_silver(spark, path)
    shown = {
        "dedup (bronze -> latest per order)": deduplicate(_bronze(spark, sf_dir)),
        "copies removed (bronze -> all but the latest)": duplicates_removed(_bronze(spark, sf_dir)),
        "sales_by_region (from silver)": M.build_sales_by_region(done),
        "product_performance, rank in 8 buckets (from silver; the searches have run)": M.build_product_performance(done, num_partitions=8),
        "customer_segments, tiles by bounds (from silver; the searches have run)": M.build_customer_segments(done),
        "silver write layout (rebalance on partition columns)": _silver(spark, sf_dir).hint("rebalance", *schema.SILVER_PARTITIONS),
    }
    for title, df in shown.items():
        df.write.format("noop").mode("overwrite").save()
        print(f"## {title}\n\n```\n{plan(df)}\n```\n")


if __name__ == "__main__":
    main()
