"""Time the registered queries; print one line of JSON.

BENCH_SF_DIR  folder of the input tables   (default /root/testdata/sf0.1)
BENCH_CPUS    local cores                  (default 8)
BENCH_ONLY    names of queries, comma-separated (default all)
BENCH_RUNS    runs of each query; the fastest counts (default 2)

Every query runs to the end into Spark's noop sink, so all rows and columns are
computed and none reaches the driver.  Queries that write or stream do all of
that within the time taken.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from facetable.plans.registry import QUERIES
from facetable.session import build_session, drop_scratch


def timed(spark, folder: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    taken = time.perf_counter() - start
    drop_scratch(spark)
    return taken


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    only = [name for name in os.environ.get("BENCH_ONLY", "").split(",") if name]
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": cores,
        "spark.driver.memory": "8g",
        # Local mode has one machine, so a folder on it is shared by all tasks.
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="facetable-bench-"),
    }
    spark = build_session("facetable-bench", f"local[{cores}]", conf)
    spark.sparkContext.setLogLevel("ERROR")

    seconds = {}
    for name in only or QUERIES:
        seconds[name] = round(min(timed(spark, folder, name) for _ in range(runs)), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr)
    spark.stop()
    result = {
        "metric": "sum of the fastest run of each query",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
