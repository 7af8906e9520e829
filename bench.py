"""Time the registered queries and print one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local cores), BENCH_RUNS (most
timed runs per query, default 3), BENCH_QUERIES (comma separated names; default:
all). Each query has one warm-up run, then timed runs until there are enough or
three seconds are spent; the median counts. Results are forced by a ``noop``
write.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from millrace.session import get_session
from workload.queries import REGISTRY


def timed(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = [n for n in chosen.split(",") if n] or list(REGISTRY)
    spark = get_session(
        f"local[{cpus}]",
        "bench",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    seconds = {}
    for name in names:
        timed(spark, name, folder)
        times = [timed(spark, name, folder)]
        while len(times) < runs and sum(times) < 3:
            times.append(timed(spark, name, folder))
        seconds[name] = round(statistics.median(times), 4)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total median seconds over registered queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
