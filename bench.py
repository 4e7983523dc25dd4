"""Times the headline queries and prints one JSON line.

Business queries count with the better of two full runs, reviews with their only run.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import sys
import time

from ledgerlens.plans import review
from ledgerlens.plans.registry import QUERIES
from ledgerlens.session import get_spark

HEADLINE = (
    "c01_overview", "c05_segment_split", "c06_wholesale_revenue_cells", "c07_warehouse_performance", "c08_product_performance",
    "c09_payment_mix", "c11_payment_by_client", "c13_price_and_quantity", "c14_price_difference", "c15_revenue_concentration",
    "c16_scores_by_stay", "c17_score_correlations", "c18_severity_breakdown", "c20_sales_profit_pivot", "c24_top_products",
    "d01_monthly_trend", "d02_warehouse_trend", "d04_top_per_group", "e03_top_orders", "e04_top_fraction",
    "a08_primary_key_check", "a09_not_null_check", "g27_duplicates_typed", "i01_repeated_rows", "i12_describe_missing",
)
# Each of these starts from the source table: the profile is computed anew.
REVIEWS = (
    "g_profile_lineitem", "g_profile_events", "g_profile_documents", "h01_h22_findings_planted", "h01_h22_findings_orders",
    "j03_precision_recall",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = get_spark("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["c05_segment_split"](spark, sf_dir).collect()  # starts the JVM's compiler; not timed
    timings: dict[str, float] = {}
    for name in HEADLINE + REVIEWS:
        runs = []
        for _ in range(2 if name in HEADLINE else 1):
            review.forget_profiles()
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        timings[name] = round(min(runs), 3)
        print(name, timings[name], file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_seconds_headline_queries", "value": round(sum(timings.values()), 3), "unit": "sec",
                      "queries": timings, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
