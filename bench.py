"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder of the given tables, BENCH_CPUS the local threads.
Each query runs in full into a sink that keeps nothing; the first one pays for
starting Spark, so a small query goes ahead unmeasured.  All queries then run once more:
``queries`` has the first, ``repeated`` the second run of each.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from mattone.plans.queries import QUERIES  # noqa: E402
from mattone.session import drop_work, use_work_base  # noqa: E402

HEADLINE = [
    "etl_listing_records",
    "build_details",
    "unknown_terms",
    "validate_listings",
    "harvest_links",
    "harvest_cards",
    "crawl_gate",
    "normalize_text",
    "insert_ignore",
    "stream_insert_ignore",
    "csv_roundtrip",
    "pending_details",
    "lookup_array",
    "lookup_matches",
    "dedupe_content",
    "dedupe_key",
    "range_sorted",
    "merge_edges",
    "strong_paths_all",
    "neighbourhood",
    "neighbourhood_all",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    # What a user's own session has: no setting of this package's beyond the partition count.
    settings = {"spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC", "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"}
    spark = SparkSession.builder.master(f"local[{cpus}]").appName("bench").config(map=settings).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    use_work_base(tempfile.mkdtemp(prefix="bench-"))
    QUERIES["count_docs"](spark, folder).collect()
    rounds: list[dict[str, float]] = [{}, {}]
    for seconds in rounds:
        for name in sys.argv[1:] or HEADLINE:
            began = time.time()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.time() - began, 3)
    drop_work(spark)
    first, again = rounds
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    total = round(sum(first.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": first, "repeated": again, "sf": scale}))


if __name__ == "__main__":
    main()
