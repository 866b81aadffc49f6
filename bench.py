"""Benchmark the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8), BENCH_RUNS (default 3), BENCH_QUERIES (comma list),
BENCH_EVENT_LOG_DIR (optional: write Spark's event log there).
Each query is executed in full with the ``noop`` sink (every column is
computed, nothing is collected), once untimed to warm the JVM, then
BENCH_RUNS times; the reported time is the median run. A run includes
building the plan, so eager steps (size checks, marks, materialized
intermediates, scratch writes) are counted.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["profile_product", "star_enrich", "log_parse", "incremental_id_range",
            "weather_fact", "csv_typed_scan", "spec_clean", "surrogate_key"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]

    from sluice.plans.catalog import queries
    from sluice.session import get_spark

    extra = {"spark.driver.memory": "16g"}
    event_dir = os.environ.get("BENCH_EVENT_LOG_DIR")
    if event_dir:  # stage and task times for offline reading; the UI stays off
        os.makedirs(event_dir, exist_ok=True)
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_dir})
    spark = get_spark(f"local[{cpus}]", app="sluice-bench", shuffle_partitions=cpus * 2, extra=extra)
    qs = queries()
    times: dict[str, float] = {}
    for name in names:
        # One untimed run per query: JVM class loading and code generation.
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "headline_total_median_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
