"""Benchmark of the headline queries.

Runs each query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` (default 8) with ``$BENCH_MEMORY`` driver heap
(default 8g): one warm-up, then the median of
``$BENCH_RUNS`` (default 5) timed runs. A run executes the full plan into
Spark's ``noop`` sink, so nothing is collected on the driver. Prints one JSON
line; ``value`` is the sum of the per-query medians, ``flow_seconds`` the
median time of the whole write-through run flow (``BENCH_FLOW=0`` skips it).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "standardized_trips",
    "valid_fares",
    "trip_details",
    "daily_metrics",
    "location_performance",
    "vendor_performance",
    "dq_report",
    "scd2_apply",
    "vendor_match_scores",
]


def run_flow(spark, sf_dir: str, runs: int) -> float:
    """Median time of the whole run flow (raw → processed → masters → curated
    → typed export, every stage writing its snapshots) into a fresh lake."""
    from farelake.plans import runs as flow
    from farelake.session import scratch_path
    from farelake.sources.lookups import ratecode_dictionary, vendor_dictionary, zone_lookup_rows
    from farelake.sources.trips import raw_trips

    samples = []
    for i in range(runs + 1):
        lake = flow.Lakehouse(spark, scratch_path(spark, "bench-lake"), prefix=f"bench{i}")
        t0 = time.perf_counter()
        flow.run(
            lake,
            raw_trips(spark, sf_dir),
            zone_lookup_rows(spark, sf_dir),
            vendor_dictionary(spark),
            ratecode_dictionary(spark),
        )
        if i:
            samples.append(time.perf_counter() - t0)
    return round(statistics.median(samples), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else HEADLINE

    from farelake.plans.catalog import queries
    from farelake.session import build_session

    memory = os.environ.get("BENCH_MEMORY", "8g")
    spark = build_session(
        f"local[{cpus}]",
        shuffle_partitions=cpus,
        app_name="farelake-bench",
        extra={"spark.driver.memory": memory},
    )
    registry = queries()
    timings: dict[str, float] = {}
    for name in names:
        samples = []
        for i in range(runs + 1):
            t0 = time.perf_counter()
            registry[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i:
                samples.append(time.perf_counter() - t0)
        timings[name] = round(statistics.median(samples), 3)

    flow = None
    if os.environ.get("BENCH_FLOW", "1") != "0":
        flow = run_flow(spark, sf_dir, runs=min(runs, 3))
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "sum_of_median_query_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                "cpus": cpus,
                "memory": memory,
                "runs": runs,
                "flow_seconds": flow,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
