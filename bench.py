"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line:
{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query runs to completion through the ``noop`` sink (the full plan
executes, nothing is collected to the driver). Landing the adapter tables
(postings, bronze, the previous day's silver, second source, housing CSV, page log) is timed once as ``setup_sec``.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "city_job_stats", "latest_city_snapshot", "top_cities_active", "city_trend", "job_persistence",
    "lifecycle_batch", "lifecycle_upsert", "job_calls_upsert", "insert_ignore",
    "enrich_payload", "incremental_work_set", "silver_upsert", "silver_v1",
    "classify_postings", "classify_documents", "industry", "affordability", "wow_change",
    "page_cutoff", "dq_report",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    from jobmart.session import get_spark

    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    from jobmart.plans import registry

    qs = registry.queries()
    t0 = time.time()
    registry.postings(spark, sf_dir).count()
    registry.bronze(spark, sf_dir).count()
    registry.housing_wide(spark, sf_dir).count()
    registry.landed(spark, sf_dir).count()
    registry.silver_prev(spark, sf_dir).count()
    registry.second_source_bronze(spark, sf_dir).count()
    setup = time.time() - t0
    times: dict[str, float | None] = {}
    failed: dict[str, str] = {}
    for name in only or HEADLINE:
        t = time.time()  # building the plan can run jobs too (e.g. the median's band check)
        try:
            df = qs[name](spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()
            times[name] = round(time.time() - t, 3)
        except Exception as e:  # noqa: BLE001 - report it and keep the one-line contract
            times[name] = None
            failed[name] = f"{type(e).__name__}: {str(e)[:200]}"
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "total_query_seconds", "value": round(sum(v for v in times.values() if v is not None), 3),
           "unit": "sec", "queries": times, "sf": m.group(1) if m else sf_dir, "setup_sec": round(setup, 3),
           "cpus": int(cpus)}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
