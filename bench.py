"""Times the decision queries on the stored models and prints one JSON line.

The models are loaded once (``load_sec``); each query then runs seven times, the first two
runs are dropped as warm-up and the median of the other five is reported.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from caseloom.plans import registry  # noqa: E402
from caseloom.plans.catalog import CATALOG, timed  # noqa: E402
from caseloom.session import build_session  # noqa: E402

LOADED = ["fact", "buckets", "bucket_rows", "monthly_aggregates", "borders"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "7"))
    size = sum(os.path.getsize(path) for path in glob.glob(f"{sf_dir}/*.parquet"))
    spark = build_session("caseloom-bench", f"local[{cpus}]", size, int(cpus), **{
        "spark.ui.enabled": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    started = time.perf_counter()
    warehouse = registry.bound_warehouse(spark, sf_dir)
    for table in LOADED:
        warehouse.table(table)
    load = time.perf_counter() - started

    answers = registry.all_queries()
    timings, spread = {}, {}
    for query_id, entry in CATALOG.items():
        for model in entry.models:
            name = f"q{int(query_id[1:]):02d}_{model}"
            result = timed(lambda: answers[name](spark, sf_dir), runs=runs, warm_ups=2)
            timings[name] = round(result["median"], 4)
            spread[name] = [round(result["p25"], 4), round(result["p75"], 4)]
    rows = warehouse.table("fact").count()
    spark.stop()
    print(json.dumps({
        "metric": "decision_queries_total_median", "value": round(sum(timings.values()), 3),
        "unit": "sec", "queries": timings, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "fact_rows": rows, "load_sec": round(load, 2), "p25_p75": spread, "runs": runs,
    }))


if __name__ == "__main__":
    main()
