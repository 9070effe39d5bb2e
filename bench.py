"""Times the headline queries: prints one JSON line with seconds per query and rows per second."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from boxweave.plans.catalog import QUERIES  # noqa: E402
from boxweave.plans.views import boxes, pool, raw, table  # noqa: E402

# Headline query -> driver table whose rows it processes.
HEADLINE = {
    "a3_group_stats": "lineitem",
    "a5_flagged_boxes": "lineitem",
    "v7_conversion_tallies": "lineitem",
    "k5_selected_images": "lineitem",
    "g4_carried_boxes": "lineitem",
    "d1_exact_duplicates": "documents",
    "d4_near_pairs": "embeddings",
    "d6_nearest_kept": "embeddings",
    "p5_assigned_splits": "documents",
    "x5_image_scores": "lineitem",
    "r9_diff_classes": "lineitem",
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("boxweave-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # The inputs proper are box files and an image pool; here they are derived from the driver tables once.
    start = time.perf_counter()
    boxes(spark, sf_dir).count(), raw(spark, sf_dir).count(), pool(spark, sf_dir).count()
    derive = round(time.perf_counter() - start, 3)
    seconds, rate = {}, {}
    for name, source in HEADLINE.items():
        rows = table(spark, sf_dir, source).count()
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        rate[name] = round(rows / seconds[name])
        spark.catalog.clearCache()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows_per_sec": rate,
                "derive_inputs_sec": derive,
                "cores": int(cpus),
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
