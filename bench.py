"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR   folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_REPEAT   runs per query, the best counts (default 2)
BENCH_QUERIES  comma-separated names, or "all" (default: the headline queries)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from counterfoil.plans.registry import QUERIES  # noqa: E402
from counterfoil.session import local_session  # noqa: E402

HEADLINE = (
    "etl_clean_orders", "etl_orderlines", "v_customers2", "v_product_buyers", "v_customer_purchases",
    "v_product_buyers_all", "mv_refresh_customers", "mv_refresh_products", "fill_unit_price", "fill_order_total",
    "sales_tax", "sales_report", "sales_report_all", "price_history", "doc_products", "doc_orders",
    "doc_customer_orders", "doc_top_customers", "mongo_top10_customers", "mongo_best_product", "apply_inserts",
    "apply_updates", "apply_deletes", "apply_changes", "upsert_orderlines", "check_ids", "doc_diff",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if wanted == "all" else wanted.split(",") if wanted else HEADLINE
    spark = local_session(cores, "counterfoil-bench")
    spark.sparkContext.setLogLevel("OFF")
    seconds = {}
    for name in names:
        runs = []
        for _ in range(repeat):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total of best run per query",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cores": cores,
            }
        )
    )


if __name__ == "__main__":
    main()
