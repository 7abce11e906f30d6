"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line: total seconds over the headline queries and per-query
seconds.  Each query runs to its full result (every row of every column goes
to a no-op sink; nothing is sampled).  A query's first run is reported as
``cold`` (it includes one-time code generation); ``queries`` holds the
median of the next ``BENCH_RUNS`` runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from eddyline.plans import QUERIES  # noqa: E402
from eddyline.session import build_session  # noqa: E402

HEADLINE = [
    "word_count",
    "access_window_reduce",
    "access_window_reduce_stream",
    "access_window_stats",
    "access_window_stats_stream",
    "word_sessions",
    "orders_union",
    "count_average",
    "count_window_reduce",
    "chunk_rows",
    "late_split",
    "word_sessions_stream",
    "late_rows_stream",
    "count_average_stream",
    "chunk_rows_stream",
]


def _run(spark, name, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    # Force the whole result: a no-op sink reads every row of every column.
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus),
                          conf={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    _run(spark, "prefix_lines", sf_dir)      # JVM and file-listing warm-up
    times, cold = {}, {}
    for name in names:
        t0 = time.perf_counter()
        _run(spark, name, sf_dir)
        cold[name] = round(time.perf_counter() - t0, 3)
        laps = []
        for _ in range(runs):
            t0 = time.perf_counter()
            _run(spark, name, sf_dir)
            laps.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(laps), 3)
    rows_in = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "cold": cold, "sf": sf,
                      "events_rows": rows_in, "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
