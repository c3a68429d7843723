"""Pull audit log (bronze.job_calls): additive upsert, consolidation, dedupe, gaps.

A *pull* is one (run_date, city, role) search; a run executes its pulls one
after another, so a posting found by two pulls on the same day is new only for
the first pull (in pull order) of the first run that saw it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobmart.operators.lifecycle import KEY

CALL_KEY = ["run_date", "city", "role"]
CALL_COLS = CALL_KEY + ["pages_fetched", "api_count", "api_mean_salary", "jobs_retrieved"]


def empty_calls(spark) -> DataFrame:
    return spark.createDataFrame([], "run_date date, city string, role string, pages_fetched bigint, "
                                     "api_count bigint, api_mean_salary double, jobs_retrieved bigint")


def pull_stats(sightings: DataFrame) -> DataFrame:
    """Per pull: pages fetched, the API's reported count and mean (from its first page)."""
    return sightings.groupBy(*CALL_KEY).agg(
        F.count("*").alias("pages_fetched"),
        F.count_distinct("job_id").alias("api_count"),
        F.min_by("value", F.struct("ts", "event_id")).alias("api_mean_salary"))


def new_per_pull(sightings: DataFrame, run_col: str = "run") -> DataFrame:
    """Jobs credited as new to each (run_date, run, city, role).

    The first pull in (run, city, role) order that saw a job on a day gets the
    credit — the day-by-day lifecycle upsert reports exactly those rows as
    changed. Both steps are partial aggregations.
    """
    first = sightings.groupBy(*KEY, "run_date").agg(F.min(F.struct(run_col, "city", "role")).alias("_p"))
    return (first.groupBy("run_date", F.col(f"_p.{run_col}").alias(run_col), F.col("_p.city").alias("city"),
                          F.col("_p.role").alias("role"))
            .agg(F.count("*").alias("jobs_retrieved")))


def calls_batch(sightings_of_run: DataFrame, credited: DataFrame) -> DataFrame:
    """One audit row per pull of a run that found new jobs (no row when nothing new)."""
    return (pull_stats(sightings_of_run).join(credited, CALL_KEY, "inner")
            .where(F.col("jobs_retrieved") > 0).select(*CALL_COLS))


def upsert_calls(target: DataFrame, batch: DataFrame) -> DataFrame:
    """SNK-6: ``ON CONFLICT (run_date, city, role)``: jobs_retrieved adds up, the rest is overwritten."""
    b = batch.select(*CALL_KEY, *[F.col(c).alias(f"_b_{c}") for c in CALL_COLS if c not in CALL_KEY])
    m = target.join(b, CALL_KEY, "full")
    hit = F.col("_b_jobs_retrieved").isNotNull()
    return m.select(
        *CALL_KEY,
        *[F.when(hit, F.col(f"_b_{c}")).otherwise(F.col(c)).alias(c) for c in ("pages_fetched", "api_count", "api_mean_salary")],
        F.when(hit, F.coalesce(F.col("jobs_retrieved"), F.lit(0)) + F.col("_b_jobs_retrieved"))
        .otherwise(F.col("jobs_retrieved")).alias("jobs_retrieved"))


def consolidate(page_log: DataFrame) -> DataFrame:
    """AGG-11 / PIP-9: one row per pull from a one-row-per-page log."""
    return page_log.groupBy("city", "role", "run_date").agg(
        F.count("*").alias("pages_fetched"),
        F.max("api_count").alias("api_count"),
        F.max("api_mean_salary").alias("api_mean_salary"),
        F.min("pulled_at").alias("pulled_at"),
        F.max("jobs_retrieved").alias("jobs_retrieved"))


def duplicate_keys(log: DataFrame) -> DataFrame:
    """AGG-12: keys present more than once (``GROUP BY … HAVING COUNT(*) > 1``)."""
    return log.groupBy(*CALL_KEY).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def duplicate_rows(log: DataFrame) -> DataFrame:
    """JOIN-8: every row whose key is duplicated (tuple ``IN`` sub-query as a semi-join).

    The key list is derived (an aggregate), so no eager size probe: AQE sees its
    real size after the aggregation and broadcasts it when small; otherwise the
    shuffled semi-join's skew handling splits a hot key.
    """
    return log.join(duplicate_keys(log).select(*CALL_KEY), CALL_KEY, "left_semi")


def keep_latest(log: DataFrame, order: list[str]) -> DataFrame:
    """WIN-2 / JOIN-10: one row per key, the latest by ``order`` (partial-aggregated)."""
    rest = [c for c in log.columns if c not in CALL_KEY]
    rec = F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")
    return log.groupBy(*CALL_KEY).agg(rec).select(*CALL_KEY, *[F.col(f"_r.{c}").alias(c) for c in rest])


def missing_pulls(sightings: DataFrame, calls: DataFrame, roles: list[str]) -> DataFrame:
    """SRC-4 / JOIN-9: expected (day, city, role) grid minus recorded pulls.

    The grid is the distinct (day, city) pairs expanded by the configured role
    list (a fixed, small array), then anti-joined with the audit table.
    """
    grid = (sightings.select("run_date", "city").distinct()
            .select("run_date", "city", F.explode(F.array(*[F.lit(r) for r in roles])).alias("role")))
    return grid.join(calls.select(*CALL_KEY), CALL_KEY, "left_anti")


def market_size(calls: DataFrame) -> DataFrame:
    """AGG-20: latest reported market size and mean salary per (city, role)."""
    return calls.groupBy("city", "role").agg(
        F.max("run_date").alias("latest_run_date"),
        F.max_by("api_count", "run_date").alias("api_count"),
        F.max_by("api_mean_salary", "run_date").alias("api_mean_salary"),
        F.sum("jobs_retrieved").alias("jobs_retrieved_total"))
