"""Benchmark: run every registered query on $BENCH_SF_DIR with local[$BENCH_CPUS]; print one JSON line.

Each query is executed in full through Spark's ``noop`` sink (no collection to Python). Two numbers:

* ``value``: inputs built. The shared inputs (sales, cleaned order lines and runner orders, ratings, recipe bridge,
  clean weekly mart) are cached once, by one ``Inputs`` that all queries share (``build_inputs_sec``); each query's time is the median of $BENCH_REPEAT runs after
  a warm-up pass. ``clean_*``, ``normalize_list_column``, ``extend_bridge_table``, ``ratings_ingest`` and
  ``missing_weeks_of_events`` read the driver tables all the same.
* ``cold_value``: inputs cold, the library's default (mode ``none``): every query computes its inputs from the
  driver tables in one run. PLANS.md shows these plans.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerline.plans.materialized import release  # noqa: E402
from ledgerline.plans.registry import QUERIES, Inputs, build  # noqa: E402
from ledgerline.session import build_session  # noqa: E402


def run_once(spark, key: str, sf_dir: str, inputs: Inputs) -> float:
    t0 = time.perf_counter()
    build(key, spark, sf_dir, inputs).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def build_inputs(inputs: Inputs) -> float:
    t0 = time.perf_counter()
    inputs.materialize_all()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = [k for k in os.environ.get("BENCH_QUERIES", "").split(",") if k]
    keys = only or list(QUERIES)
    # small inputs: one shuffle partition per core (AQE coalesces further); clusters size this by data volume
    partitions = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(cpus)))
    spark = build_session(f"local[{cpus}]", app="ledgerline-bench", shuffle_partitions=partitions,
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    inputs = Inputs(spark, sf_dir, mode="cache")
    build_sec = build_inputs(inputs)
    for key in keys:  # warm-up: JIT, file listing caches
        run_once(spark, key, sf_dir, inputs)
    times = {}
    for key in keys:
        times[key] = round(statistics.median(run_once(spark, key, sf_dir, inputs) for _ in range(repeat)), 4)
    release(spark)
    cold = {key: round(run_once(spark, key, sf_dir, Inputs(spark, sf_dir)), 4) for key in keys}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "sum_of_query_medians",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "build_inputs_sec": round(build_sec, 3),
        "cold_value": round(sum(cold.values()), 3),
        "cold_queries": cold,
        "cpus": cpus,
        "repeat": repeat,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
