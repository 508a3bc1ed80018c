"""Time the headline queries and print one JSON line.

Settings: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 2;
the fastest run of a query counts). A run builds the query anew and computes every row.
"""

from __future__ import annotations

import json
import os
import time

from salesloom.catalog.queries import QUERIES
from salesloom.session import build_session

HEADLINE = [
    # Silver and Gold
    "orders_cleaned", "order_items_cleaned", "weather_cleaned", "fx_cleaned", "payments_cleaned",
    "source_order_items", "dim_customer", "dim_geolocation", "fact_sales", "fact_payments",
    "fact_fx_rates", "fact_upsert",
    # Marts
    "sales_enriched", "sales_with_weather", "sales_usd",
    # Measures and analyses
    "revenue_by_state", "sales_measures", "delivery_measures", "customer_loyalty", "revenue_growth",
    "revenue_to_date", "revenue_in_usd", "weather_revenue", "top_categories",
    "top_category_per_state", "seller_scorecard", "freight_ratio",
    # Quality
    "sales_quality", "table_profile", "foreign_key_counts",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(runs):
            started = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
        seconds[name] = round(min(times), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, total wall time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
        "runs": runs,
    }))


if __name__ == "__main__":
    main()
