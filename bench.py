"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default all),
BENCH_RUNS (default 3 timed runs after one warm-up, of which the median counts).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.queries import QUERIES  # noqa: E402
from tidemark.session import build_session  # noqa: E402

HEADLINE = [
    "silver_customers", "silver_products", "silver_geolocation", "silver_orders", "silver_order_items",
    "silver_order_payments", "silver_order_reviews",
    "dim_customers", "dim_products", "dim_sellers",
    "fact_orders", "fact_order_items", "fact_payments", "fact_reviews",
    "dq_relationships", "dq_report", "profile_dups", "time_slice_children",
    "ingest_incremental", "ingest_watermark_delta", "ingest_child_delta", "ingest_paged_json", "stream_dedup",
]
# Queries that build or load whole lakes; one timed run is enough.
LONG = {"dq_report", "ingest_incremental", "ingest_watermark_delta", "stream_dedup"}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "*")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": "8" if cpus == "*" else cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    timings: dict[str, float] = {}
    for name in names:
        once(name)
        timings[name] = round(statistics.median(once(name) for _ in range(1 if name in LONG else runs)), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, sum of medians",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
