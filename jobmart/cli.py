"""Command line: the daily jobs, housing loads, backfills and analyses.

    python -m jobmart.cli --root /shared/jobmart ingest-pages /landing/pages
    python -m jobmart.cli --root /shared/jobmart enrich --run-date 2024-01-31
    python -m jobmart.cli --root /shared/jobmart gold --run-date 2024-01-31
    python -m jobmart.cli --root /shared/jobmart ingest-housing zillow_zori=/landing/zori.csv
    python -m jobmart.cli --root /shared/jobmart enrich-housing zillow_zori
    python -m jobmart.cli --root /shared/jobmart backfill-seniority [--apply]
    python -m jobmart.cli --root /shared/jobmart backfill-descriptions
    python -m jobmart.cli --root /shared/jobmart analyses --run-date 2024-01-31
    python -m jobmart.cli --root /shared/jobmart data-quality
    python -m jobmart.cli --root /shared/jobmart compact
    python -m jobmart.cli --root /shared/jobmart gold-history --from-date 2024-01-01 --to-date 2024-01-31

``--run-date`` is always explicit (no "today" inside the jobs).
"""

from __future__ import annotations

import argparse
import os

from jobmart.plans import jobs
from jobmart.session import get_spark


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="jobmart")
    p.add_argument("--root", required=True, help="table root in a folder shared by the cluster")
    sub = p.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("ingest-pages")
    s.add_argument("landing")
    s.add_argument("--layout", choices=["log", "files"], default="log",
                   help="log: JSON-lines page log; files: one raw response file per page, keys in the path")
    for name in ("enrich", "gold", "analyses", "city-tables"):
        s = sub.add_parser(name)
        s.add_argument("--run-date", required=True)
        if name in ("gold", "city-tables"):
            s.add_argument("--strip-state-suffix", action="store_true", help='the housing files name metros like "Chicago, IL"')
    s = sub.add_parser("import-calls")
    s.add_argument("name", help="the import's own name; importing it again replaces its rows")
    s.add_argument("path", help="an earlier call log: parquet, or CSV with a header")
    s.add_argument("--per-pull", action="store_true", help="one row per pull, the latest of several stays (default: one row per page)")
    s = sub.add_parser("ingest-housing")
    s.add_argument("datasets", nargs="+", help="name=path.csv")
    s = sub.add_parser("enrich-housing")
    s.add_argument("name")
    s.add_argument("--metric-type", default="rent_index_latest")
    s = sub.add_parser("backfill-seniority")
    s.add_argument("--apply", action="store_true")
    sub.add_parser("backfill-descriptions")
    sub.add_parser("data-quality")
    sub.add_parser("compact")
    s = sub.add_parser("gold-history")
    s.add_argument("--from-date", required=True)
    s.add_argument("--to-date", required=True)
    a = p.parse_args(argv)

    spark = get_spark()
    if a.cmd == "ingest-pages":
        from jobmart.streaming.ingest import start_page_ingest

        start_page_ingest(spark, a.landing, a.root, layout=a.layout).awaitTermination()
    elif a.cmd == "enrich":
        jobs.enrich(spark, a.root, a.run_date)
    elif a.cmd == "gold":
        jobs.refresh_gold(spark, a.root, a.run_date, a.strip_state_suffix)
    elif a.cmd == "city-tables":
        jobs.refresh_city_tables(spark, a.root, a.run_date, a.strip_state_suffix)
    elif a.cmd == "import-calls":
        log = spark.read.csv(a.path, header=True) if a.path.endswith(".csv") else spark.read.parquet(a.path)
        jobs.import_calls(spark, a.root, log.withColumn("run_date", log["run_date"].cast("date")), a.name, not a.per_pull)
    elif a.cmd == "ingest-housing":
        jobs.ingest_housing(spark, dict(x.split("=", 1) for x in a.datasets), a.root)
    elif a.cmd == "enrich-housing":
        jobs.enrich_housing(spark, a.root, a.name, a.name, a.metric_type)
    elif a.cmd == "backfill-seniority":
        out = jobs.backfill_seniority(spark, a.root, dry_run=not a.apply)
        out["matrix"].show(truncate=False)
        out["sample"].show(truncate=False)
    elif a.cmd == "backfill-descriptions":
        jobs.backfill_descriptions(spark, a.root).show(truncate=False)
    elif a.cmd == "gold-history":
        jobs.backfill_gold_history(spark, a.root, a.from_date, a.to_date)
    elif a.cmd == "compact":
        jobs.compact_bronze(spark, a.root)
        jobs.compact_silver(spark, a.root)
    elif a.cmd == "data-quality":
        jobs.data_quality(spark, a.root).show(50, truncate=False)
    elif a.cmd == "analyses":
        for name, df in jobs.analyses(spark, a.root, a.run_date).items():
            path = os.path.join(a.root, f"analysis_{name}")
            df.write.mode("overwrite").parquet(path)  # the whole result; the screen shows its head
            print(f"{name}: {path}")
            spark.read.parquet(path).show(30, truncate=False)


if __name__ == "__main__":
    main()
