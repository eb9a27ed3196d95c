"""Headline queries at ``$BENCH_SF_DIR``; prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

HEADLINE = [
    "gold_real_estate_yoy",
    "silver_transactions",
    "dbt_mart",
    "region_year_series",
    "rank_pct_inverse",
    "territory_scores",
    "listing_stats",
    "postal_translation",
    "nearest_join",
    "equipment_counts",
    "rental_metrics",
    "projection_table",
    "knn_similar",
    "lexicon_sentiment",
    "top_words",
    "quality_checks",
    "stream_listing_stats",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from parcelle.workloads import load_all
    from parcelle.workloads.registry import QUERIES

    load_all()
    chosen = sys.argv[1:] or HEADLINE
    QUERIES[chosen[0]](spark, folder).write.format("noop").mode("overwrite").save()  # warm-up
    seconds = {}
    for name in chosen:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )


if __name__ == "__main__":
    main()
