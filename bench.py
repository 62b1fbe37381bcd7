"""Benchmark the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 3, median reported). Each run builds the query from
scratch (including its eager fit / checkpoint steps) and executes the whole
plan into Spark's no-op sink, so nothing is collected to the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

HEADLINE = (
    "call_window_join",
    "missed_status",
    "call_base_train",
    "labels_shifted",
    "call_features_all",
    "crm_clean",
    "features_joined",
    "impute_trace",
    "alerts_new",
)


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from callpulse.plans.catalog import QUERIES
    from callpulse.session import get_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = get_session(f"local[{cpus}]", shuffle_partitions=cpus * 2, app="callpulse-bench")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="callpulse-bench-ckpt-"))
    # warm-up: JIT and Python workers
    QUERIES["missed_status"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    timings: dict[str, float] = {}
    for name in HEADLINE:
        runs = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        timings[name] = round(statistics.median(runs), 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "headline_total_median_sec",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
                "repeat": repeat,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
