"""
and shuffle bytes written (from Spark's event log in a scratch folder; the UI stays off).

    python tools/measure.py [/root/testdata/sf0.1] [runs=5] > /tmp/measure.json
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

import pyspark  # noqa: E402

from ledgerline.plans.registry import QUERIES, Inputs, build  # noqa: E402
from ledgerline.session import DEFAULTS, build_session  # noqa: E402


def main(argv) -> None:
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    runs = int(argv[2]) if len(argv) > 2 else 5
    log_dir = tempfile.mkdtemp(prefix="ledgerline-eventlog-")
    extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir, "spark.eventLog.compress": "false"}
    spark = build_session("local[8]", app="ledgerline-measure", shuffle_partitions=8, extra=extra)
    sc = spark.sparkContext
    t0 = time.perf_counter()
    inputs = Inputs(spark, sf, mode="cache")
    inputs.materialize_all()
    build_sec = time.perf_counter() - t0
    out = {}
    for key in QUERIES:
        def run():
            s = time.perf_counter()
            build(key, spark, sf, inputs).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - s
        run()
        times = [run() for _ in range(runs)]
        sc.setJobGroup(f"measure:{key}", key)
        run()
        sc.setJobGroup("other", "other")
        rows = build(key, spark, sf, inputs).count()
        out[key] = {"median": round(statistics.median(times), 3), "worst": round(max(times), 3), "rows": rows}
    spark.stop()
    stage_group, shuffle = {}, {}
    for path in sorted(glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)):
        if os.path.isdir(path):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id", "")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    group = stage_group.get(ev.get("Stage ID"), "")
                    if group.startswith("measure:"):
                        w = ev.get("Task Metrics", {}).get("Shuffle Write Metrics", {}).get("Shuffle Bytes Written", 0)
                        shuffle[group[8:]] = shuffle.get(group[8:], 0) + w
    for key in out:
        out[key]["shuffle_bytes"] = shuffle.get(key, 0)
    conf = dict(DEFAULTS, **{"spark.sql.shuffle.partitions": "8"})
    print(json.dumps({"sf_dir": sf, "runs": runs, "cores": 8, "spark": pyspark.__version__, "config": conf,
                      "build_inputs_sec": round(build_sec, 3), "queries": out}))


if __name__ == "__main__":
    main(sys.argv)
