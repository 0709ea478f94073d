"""Time the headline queries on the tables below $BENCH_SF_DIR and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from ledgerloom.catalog.queries import build
from ledgerloom.session import get_session

HEADLINE = (
    "stg_orders",
    "stg_order_items",
    "enriched_items",
    "fct_daily_sales",
    "exec_kpis",
    "sales_by_category",
    "margin_by_category",
    "kpi_headline",
    "inventory_position",
    "inventory_health",
    "inventory_health_product",
    "items_for_slice",
    "late_window_slice",
    "fact_upsert",
    "scd2_products",
    "events_daily",
    "dq_raw_gate",
    "dq_model_tests",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    spark = get_session(
        "bench", master=f"local[{cpus}]",
        **{"spark.ui.enabled": "false", "spark.driver.memory": "16g",
           "spark.sql.shuffle.partitions": cpus, "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")

    # One small query first, so that starting the JVM is not counted.
    build("margin_by_category", spark, sf_dir).collect()
    seconds = {}
    for name in HEADLINE:
        best = None
        for _ in range(repeats):
            started = time.perf_counter()
            build(name, spark, sf_dir).write.format("noop").mode("overwrite").save()
            spent = time.perf_counter() - started
            best = spent if best is None else min(best, spent)
        seconds[name] = round(best, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
