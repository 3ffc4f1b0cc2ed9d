"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and ``BENCH_CPUS`` (default 8) choose data and cores.
Each query runs to completion into a sink that discards rows; the JVM is warmed up by one small run.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from verification.queries import QUERIES

HEADLINE = [
    "clean_text", "normalize_key", "normalize_email", "normalize_phone", "normalize_skus", "parse_number", "parse_dates",
    "dedup_exact", "dedup_keep_first", "link_records", "golden_record", "clean_customers", "change_log", "enrich_catalog",
    "merged_sales", "pivot_with_totals", "top_products", "reconcile_totals", "ingest_encoding_profile", "ingest_mixed_csv",
    "locale_csv",
]


def run(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("sparktidy-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in ("parse_number", "link_records"):
        run(spark, name, sf_dir)
    times = {name: round(run(spark, name, sf_dir), 3) for name in HEADLINE}
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf_dir.rstrip("/").rsplit("/", 1)[-1]}))


if __name__ == "__main__":
    main()
