"""Headline queries at one scale factor; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) set the input and the local cores.
Names given as arguments replace the headline list; ``all`` runs every registered query.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

HEADLINE = [
    "b10_package_fan_out", "s7_ordered_insert", "j3_left_outer", "j13_rate_asof", "j12_postal_range",
    "load_packages", "revenue_by_tier_and_month", "b14_event_timeline", "load_events", "w8_latest_per_entity",
    "q8_tracking_time_order", "q8_time_order", "w2_row_number_in_group", "w5_running_sum",
    "load_invoices", "b24_payment_application", "b26_facility_tree", "b29_weighted_pick",
    "load_warehouse", "q6_exactly_one", "q9_required_and_length", "t4_top_waits", "t7_job_outcomes", "t12_deadlock_graphs",
    "r2_alert_suppression", "r3_current_status", "r4_late_events",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("haulmark-bench")
             .config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
             .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g")).getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")

    from haulmark.catalog.all_queries import PLANS, run
    from haulmark.catalog.registry import lake_for

    lake = lake_for(spark, sf_dir)
    # The numbered tables are loaded once per session; their load is timed on its own.
    loads = {"load_packages": lambda: lake.packages, "load_events": lambda: lake.tracking_events,
             "load_invoices": lambda: lake.invoice_heads, "load_warehouse": lambda: lake.spark.createDataFrame(list(lake.warehouse.load_all().items()), "t string, n long")}
    names = sys.argv[1:] or HEADLINE
    if names == ["all"]:
        names = [*loads, *PLANS]
    # Start the executor threads and load the join, aggregate and Parquet classes before the clock runs.
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    nation.join(nation.select("n_nationkey"), "n_nationkey").groupBy("n_regionkey").count().collect()

    times: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        try:
            frame = loads[name]() if name in loads else run(name, spark, sf_dir)
            frame.write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
        except Exception as error:  # noqa: BLE001
            times[name] = -1.0
            print(f"{name}: {type(error).__name__}: {str(error)[:300]}", file=sys.stderr)
    spark.stop()
    total = round(sum(t for t in times.values() if t > 0), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times,
                      "sf": Path(sf_dir).name.removeprefix("sf")}))


if __name__ == "__main__":
    main()
