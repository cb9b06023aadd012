"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs fully (``noop`` sink: every row is produced, nothing is
collected to the driver) once to warm up, then ``$BENCH_RUNS`` times; the
median is reported. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["student_summary", "compare_city", "compare_state", "latest_event", "hybrid_panel", "targets_panel",
            "indicators_state", "clean_table", "quality_metrics"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE

    from indicata.plans.queries import REGISTRY
    from indicata.session import local_session

    extra = {"spark.driver.memory": "16g", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true"}
    event_log = os.environ.get("BENCH_EVENT_LOG")  # folder for Spark's event log (stage/task times)
    if event_log:
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_log})
    spark = local_session(cpus, max(8, 2 * cpus), "indicata-bench", extra)
    timings = {}
    for name in names:
        fn = REGISTRY[name]

        def once():
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0

        once()
        timings[name] = round(statistics.median(once() for _ in range(runs)), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(timings.values()), 3), "unit": "sec",
                      "queries": timings, "sf": sf, "cpus": cpus, "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
