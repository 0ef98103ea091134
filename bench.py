"""Times the headline queries, after one run each on the smallest tables, and prints one JSON line.

Each query runs to completion on executors (noop sink): no rows come back to the driver.
BENCH_SF_DIR, BENCH_CPUS and BENCH_QUERIES (comma-separated, or "all") set the run.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillroll import registry
from tillroll.session import get_session

HEADLINE = [
    "daily_revenue_change", "business_totals", "basket_size", "check_distribution", "outlier_receipts",
    "top_customers", "menu_engineering", "abc_classes", "weekly_product_mix", "same_weekday_growth",
    "rolling_revenue_7d", "staffing_matrix", "segments_by_weekday", "falling_demand", "sales_enriched",
    "reorder_point", "product_totals_per_line", "inventory_gap", "return_rate", "slow_assembly_top3",
    "cohort_ltv_margin", "revenue_heatmap", "describe_numeric", "interpolate_per_user", "winsorise",
    "audit_methods_differ", "expand_day_orders",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES", "")
    spark = get_session(
        "bench", f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus, spark__driver__memory="12g", spark__ui__showConsoleProgress="false",
        spark__sql__autoBroadcastJoinThreshold="1m",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    names = list(queries) if wanted == "all" else [n for n in wanted.split(",") if n] or HEADLINE

    def run(name: str, data: str) -> float:
        start = time.perf_counter()
        queries[name](spark, data).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    # compile the generated code on the smallest tables, if they are there, so that the
    # timed runs measure the work and not the virtual machine's start
    small = os.path.join(os.path.dirname(folder.rstrip("/")), "sf0.001")
    if os.path.isdir(small):
        for name in names:
            run(name, small)
    times = {name: round(run(name, folder), 3) for name in names}
    print(json.dumps({
        "metric": "headline queries, total time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
