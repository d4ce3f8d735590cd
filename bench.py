"""Timing of the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from listwright.session import build_session
from workload.registry import QUERIES

HEADLINE = [
    "dedupe_first", "dedupe_id_url", "min_date", "completeness", "price_stats", "top_cities", "quality_score",
    "issue_counts", "report_full", "merge_narrow", "insert_new", "store_recent", "ascii_fold", "normalise_label",
    "title", "text_lines", "links_p1", "crawl_extent", "extract_p1", "extract_p2", "extract_p3", "json_roundtrip",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # start the JVM's code paths and the Python workers outside the timings
    QUERIES["title"](spark, sf_dir).limit(1).collect()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")), "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
