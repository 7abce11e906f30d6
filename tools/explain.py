"""Print the formatted physical plan of named queries.

    python tools/explain.py [--sf-dir DIR] access_window_reduce word_sessions

Streaming queries run to completion first (they return what their sink
wrote), so their plan is the read of that output; explain the operators on
a streaming frame directly to see a stream's plan.
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("--mode", default="formatted",
                    choices=["simple", "extended", "codegen", "cost", "formatted"])
    ap.add_argument("names", nargs="+")
    a = ap.parse_args()
    from eddyline.plans import QUERIES
    from eddyline.session import build_session
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    for name in a.names:
        print(f"===== {name}")
        QUERIES[name](spark, a.sf_dir).explain(a.mode)


if __name__ == "__main__":
    main()
