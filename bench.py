"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores, BENCH_RUNS the timed runs per
query (the median counts). One untimed query warms the session up. Each run computes all rows and
columns into a sink that keeps nothing.
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from patronage.plans.catalog import QUERIES  # noqa: E402
from patronage.session import build_session  # noqa: E402

HEADLINE = [
    "s1_valid_trades",
    "w5_shop_rfm",
    "w7_all_levels",
    "w13_final_daily_rfm",
    "w16_late_assemble",
    "w18_late_patch",
    "w20_month_end_rfm",
    "r9_segmentation_report_rf",
    "r9_segmentation_report_rm",
    "r10_repeat_interval",
    "c2_assets_view",
    "c3_repurchase_view",
    "v6_sales_structure_month",
    "v6_sales_structure_year",
    "b10_category_assets",
    "m11_point_grade_report",
    "m13_grade_matrix_report",
    "m15_consume_transform",
    "m20_life_cycle_report",
    "o12_consumption_report",
    "l5_shop_label",
    "t7_tenant_label",
    "d5_funnel_report",
    "e2_enrich_audience",
    "e6_exclude_rebought_all_days",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8)))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", "bench", partitions=cpus, driver_memory="16g")
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run(names[0])
    times = {name: round(statistics.median([run(name) for _ in range(runs)]), 3) for name in names}
    result = {
        "metric": "headline queries, total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")),
        "cpus": cpus,
        "runs": runs,
        "spark": spark.version,
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
