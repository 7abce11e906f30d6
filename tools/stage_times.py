"""Stage times of named queries from Spark's event log.

    python tools/stage_times.py [--sf-dir DIR] access_window_reduce word_sessions

The event log goes to a new scratch folder (no web UI is started).  Each
query runs once to warm up, then once measured; the measured run's stages are
listed with their duration, task count and shuffle bytes written.
"""

from __future__ import annotations

import argparse
import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.1")
    ap.add_argument("names", nargs="+")
    a = ap.parse_args()
    from eddyline.plans import QUERIES
    from eddyline.session import build_session
    logdir = tempfile.mkdtemp(prefix="eddyline-eventlog-")
    spark = build_session("local[8]", shuffle_partitions=8, conf={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": logdir,
        "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    spans = {}
    for name in a.names:
        QUERIES[name](spark, a.sf_dir).write.format("noop").mode("overwrite").save()
        t0 = time.time() * 1000
        QUERIES[name](spark, a.sf_dir).write.format("noop").mode("overwrite").save()
        spans[name] = (t0, time.time() * 1000)
    spark.stop()
    log = max(glob.glob(os.path.join(logdir, "**", "*"), recursive=True), key=os.path.getsize)
    stages = []
    with open(log) as f:
        for line in f:
            e = json.loads(line)
            if e["Event"] != "SparkListenerStageCompleted":
                continue
            si = e["Stage Info"]
            written = sum(x.get("Value", 0) for x in si.get("Accumulables", [])
                          if x.get("Name") == "internal.metrics.shuffle.write.bytesWritten")
            stages.append((si.get("Submission Time"), si.get("Completion Time"),
                           si["Number of Tasks"], written))
    for name, (t0, t1) in spans.items():
        mine = [s for s in stages if s[0] and t0 <= s[0] <= t1]
        print(f"{name}: {t1 - t0:.0f} ms, {len(mine)} stages, "
              f"{sum(s[2] for s in mine)} tasks, {sum(s[3] for s in mine) / 1e6:.1f} MB shuffled")
        for sub, done, tasks, written in mine:
            print(f"    {done - sub:6.0f} ms  {tasks:4d} tasks  {written / 1e6:7.2f} MB shuffle write")
    print(f"event log: {log}")


if __name__ == "__main__":
    main()
