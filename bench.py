"""Seconds per query: BENCH_SF_DIR=… BENCH_CPUS=… python bench.py [name …]

Each query runs once, after a warm-up on the smallest tables, and its whole result is produced.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from playthrough.registry import QUERIES


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("playthrough-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    warm_up = os.path.join(os.path.dirname(os.path.normpath(sf_dir)), "sf0.001")
    if os.path.isdir(warm_up):
        QUERIES["completion_prediction_features"](spark, warm_up).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in sys.argv[1:] or QUERIES:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total seconds over all queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
