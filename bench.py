"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Each query runs once to warm up and is then timed;
its whole result is computed (written to the noop sink), not just counted.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "order_report_from_feed",
    "scd1_upsert",
    "scd1_hot_keys",
    "scd1_composite_keys",
    "scd1_delete_feed",
    "scd2_history",
    "scd2_hot_keys",
    "snapshot_diff",
    "slice_after",
    "batch_trim",
    "drop_delivered",
    "slice_per_key",
    "split_even",
    "coerce_records",
    "nested_four_levels",
    "two_level_explode",
    "asof_join",
    "dirty_parents",
    "messages_per_channel",
    "active_users",
    "user_sessions",
    "interpolated_grid",
    "summary_by_time",
    "plot_points",
    "hl7_observations",
    "fhir_observations",
    "dicom_studies",
    "dedup_rows",
    "duplicate_keys",
    "hierarchy",
]


def main() -> None:
    from pyspark.sql import SparkSession

    from feedweir.plans.registry import all_queries

    cpus = os.environ.get("BENCH_CPUS", "8")
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("feedweir-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    plans = all_queries()
    seconds = {}
    for name in HEADLINE:
        for _ in range(2):
            begin = time.perf_counter()
            plans[name].plan(spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - begin, 3)
    total = round(sum(seconds.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))


if __name__ == "__main__":
    main()
