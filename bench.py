"""Benchmark of the registered queries; prints one JSON line.

BENCH_SF_DIR  data directory (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default: all, at most 8)
BENCH_RUNS    timed runs per query after one warm-up (default 3); the median is reported
Arguments name the queries to run; default: all.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from haulbook.queries import QUERIES
from haulbook.session import local_session


def seconds(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", min(8, os.cpu_count() or 1)))
    runs = int(os.environ.get("BENCH_RUNS", 3))
    spark = local_session(cpus, **{"spark.ui.showConsoleProgress": "false"})

    timings = {}
    for name in sys.argv[1:] or QUERIES:
        times = [seconds(lambda: QUERIES[name](spark, sf_dir)) for _ in range(runs + 1)]
        timings[name] = round(statistics.median(times[1:]), 3)
    spark.stop()

    line = {
        "metric": "sum of median query times",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
        "cpus": cpus,
        "runs": runs,
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
