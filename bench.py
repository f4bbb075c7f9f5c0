"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the number of local cores.  A query
runs into the noop sink, so all of its columns are computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

from orderloom.plans.catalog import registered
from orderloom.session import build_session

HEADLINES = ["fact_orders", "fact_order_line", "fact_orders_scd2", "dim_product", "metric_daily_orders",
             "metric_daily_customers", "metric_daily_products", "metrics_dashboard", "order_trends",
             "customer_behavior", "product_performance", "scd2_completion_by_size"]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    queries, seconds = registered(), {}
    names = sys.argv[1:] or HEADLINES
    registered()["stg_orders"](spark, folder).write.format("noop").mode("overwrite").save()  # warm-up
    for name in names:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline queries, wall time", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
