"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

import workload

HEADLINE = [
    "colnum_gbif", "barcode_gbif", "names_standard", "dup_stats", "crossfill_coordinates",
    "newest_determination", "dedup_numbered", "premerge", "merge_raw", "master_unnumbered",
    "expert_by_number", "resolve_taxa", "locate", "nearest_coast", "integrate", "consolidate",
    "expert_integrate", "flag_coordinates", "resolve_collectors", "fuzzy_best",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "20g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    workload.QUERIES["record_counts"](spark, folder).collect()  # warm up
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        workload.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "specimen_curation_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
