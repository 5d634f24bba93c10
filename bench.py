"""Times every registered query and prints one JSON line.

Each query is built and forced with the ``noop`` sink: one warm-up, then the median of up to
three runs (one run when the warm-up took longer than twenty seconds). Building counts, because
it contains the jobs that stage tables and measure lookups.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from spendmart.session import SETTINGS  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

SLOW_SECONDS = 20.0


def session(cpus: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or list(QUERIES)
    spark = session(cpus)
    seconds = {}
    for name in names:
        warm_up = timed(spark, name, sf_dir)
        repeat = 1 if warm_up > SLOW_SECONDS else runs
        seconds[name] = round(statistics.median(timed(spark, name, sf_dir) for _ in range(repeat)), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    result = {
        "metric": "total seconds over all queries, median run each",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
