"""Time the headline queries: median of three warm runs each, one JSON line at the end.

Reads ``BENCH_SF_DIR`` (default sf0.1) on ``local[BENCH_CPUS]``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "valid_documents",
    "load_report",
    "category_share",
    "category_topk_scores",
    "tags_topk",
    "tag_share",
    "lexicon_table_scores",
    "centroid_labels",
    "name_normalize",
    "score_pairs",
    "fuzzy_best_match",
    "fuzzy_brand_match",
    "fuzzy_customer_supplier",
    "entities_long",
    "entities_grouped",
    "location_top15",
    "completeness",
    "summary_pivot",
    "quality_metrics",
    "enrich_records",
    "enrich_matches",
    "enrich_report",
    "model_slot_errors",
    "roundtrip_csv_texts",
]
RUNS = 3


def main() -> None:
    from linkloom.plans.catalog import QUERIES

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    memory = os.environ.get("BENCH_MEMORY", "16g")
    settings = {
        "spark.driver.memory": memory,
        "spark.sql.shuffle.partitions": cpus,
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("linkloom-bench")
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    seconds: dict[str, float] = {}
    for name in HEADLINE:
        times = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds_headline_queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
                "settings": settings,
            }
        )
    )


if __name__ == "__main__":
    main()
