"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

HEADLINE = [
    "latency_stats",
    "latency_stats_by_label",
    "price_percentiles_by_flag",
    "metric_bundle",
    "throughput_by_device",
    "status_share",
    "text_length_by_lang",
    "text_length_histogram",
    "confusion",
    "decode_requests",
    "rejected_requests",
    "request_asset_join",
    "missing_assets",
    "request_generation",
    "dense_order_numbers",
    "balanced_sample",
    "size_ladder",
    "timeline",
    "latency_trend",
    "run_summary",
    "burst_drain",
    "scaling_efficiency",
    "cost_projection",
    "clean_report",
    "score_requests",
    "predictions_parquet",
    "stream_windowed",
    "stream_dedup",
]


def main() -> None:
    from pyspark.sql import SparkSession

    from loadlens import catalog

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("loadlens-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="loadlens-bench-"))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # start-up is not part of any query
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        started = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        spark.catalog.clearCache()
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
