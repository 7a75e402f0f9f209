"""Time the headline queries on local cores; prints one JSON line.

BENCH_SF_DIR   folder of test tables      (default /root/testdata/sf0.1)
BENCH_CPUS     local cores                (default all)
BENCH_RUNS     timed runs after a warm-up (default 3; the median counts)
BENCH_QUERIES  space-separated names      (default: the headline list and the long jobs, which run once)

Derived tables (persons, segments, weekly features) are built within the clock.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from pathlib import Path

from tradewind.plans.registry import forget, run
from tradewind.session import configure, get_session

HEADLINE = [
    "top_sellers_ranked", "top_sellers_limit", "monthly_growth", "monthly_orders_lag", "delivery_delay_by_state",
    "delivery_delay_top10", "repeat_purchase_rate", "category_cancellation", "category_cancellation_raw",
    "kpi_summary", "kpi_dashboard", "revenue_by_state", "revenue_by_state_all", "explore_items",
    "clean_customers", "clean_orders", "clean_order_items", "clean_reviews", "clean_products", "clean_payments",
    "describe_items", "state_revenue_stats", "status_by_year_pivot", "correlation_matrix", "box_stats",
    "rfm_values", "rfm_scores", "kmeans_segments", "weekly_features", "weekly_features_by_state", "train_forest_by_state",
    "reviews_full", "monthly_rating_trend", "category_ratings", "score_by_month_pivot",
    "repeat_customer_share", "best_category", "tag_questions", "live_kpis", "live_order_volume",
]
LONG = [
    "load_tables", "clean_report", "answer_metrics", "price_box_by_state", "elbow", "pipeline_report",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", "").split() or [*HEADLINE, *LONG]
    conf = {
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "20g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    spark = get_session("bench", f"local[{cpus}]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark, sum(f.stat().st_size for f in Path(folder).rglob("*.parquet") if f.is_file()))

    def once(name: str) -> float:
        forget()
        start = time.perf_counter()
        run(name, spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        if name not in LONG:
            once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(1 if name in LONG else runs)), 3)
    result = {
        "metric": "sum of median query times, warm; long jobs apart",
        "value": round(sum(s for name, s in seconds.items() if name not in LONG), 3),
        "long": round(sum(s for name, s in seconds.items() if name in LONG), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
