"""Time the registered queries. Prints one JSON line; each query's time is the median of its warm runs.

BENCH_SF_DIR, BENCH_CPUS, BENCH_RUNS and BENCH_QUERIES (comma-separated names) choose data, cores, runs and queries.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from subledger.registry import REGISTRY, run
from subledger.session import build_session

HEADLINE = [
    "stg_orders", "stg_line_items", "orders_enriched", "payments_reconciled", "dim_customers", "dim_products",
    "fct_orders", "fct_subscriptions", "fct_charges", "cohort_retention", "revenue_reconciliation", "subscription_health",
    "churn_mrr_bridge", "ltv_curve", "dunning_recovery", "dq_report",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES")
    chosen = list(REGISTRY) if names == "all" else names.split(",") if names else HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g",
        spark__log__level="ERROR", spark__ui__showConsoleProgress="false",
    )
    times = {}
    for name in chosen:
        taken = []
        for _ in range(runs + 1):  # the first run warms files and generated code
            start = time.perf_counter()
            run(name, spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken[1:]), 3)
    spark.stop()
    print(json.dumps({
        "metric": "sum of median warm query times", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
