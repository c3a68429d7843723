"""Analyses over the gold and silver tables (sorts, top-k, percentages).

Global top-k uses ``orderBy(...).limit(k)`` which plans as
``TakeOrderedAndProject`` (per-partition top-k, then a k-row merge); every
ordering carries a full tie-break so the chosen rows are deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pct(part: str, whole: str) -> Column:
    """NUM-1: ROUND(100.0 * part / NULLIF(whole, 0), 2) as double."""
    return F.round(F.try_divide(F.col(part) * 100.0, F.col(whole)), 2)


def top_cities_active(snapshot: DataFrame, k: int = 10) -> DataFrame:
    """SRT-1: top k cities by active jobs."""
    return (snapshot.select("city", "state", "active_jobs", "avg_salary", "new_jobs_7d", "job_growth_rate_7d")
            .orderBy(F.col("active_jobs").desc_nulls_first(), "city", "state").limit(k))


def city_trend(history: DataFrame, last_n: int = 30) -> DataFrame:
    """SRT-2 / WIN-6: latest ``last_n`` run dates per city with day-over-day change."""
    w = Window.partitionBy("city", "state").orderBy(F.desc("run_date"))
    wl = Window.partitionBy("city", "state").orderBy("run_date")
    return (history.select("city", "state", "run_date", "total_jobs", "active_jobs", "new_jobs",
                           "avg_salary_min", "avg_salary_max")
            .withColumn("active_change", F.col("active_jobs") - F.lag("active_jobs").over(wl))
            .withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") <= last_n).drop("_rn"))


def remote_share(stats: DataFrame, run_date, k: int = 10) -> DataFrame:
    """SRT-3: cities with the highest remote percentage (NULLs first, as in the source)."""
    return (stats.where(F.col("run_date") == F.lit(str(run_date)).cast("date"))
            .select("city", "state", "active_jobs", "remote_jobs", pct("remote_jobs", "active_jobs").alias("remote_percentage"))
            .orderBy(F.col("remote_percentage").desc_nulls_first(), "city", "state").limit(k))


def seniority_distribution(stats: DataFrame, run_date) -> DataFrame:
    """SRT-4: seniority mix per city, percentages over active jobs."""
    return (stats.where(F.col("run_date") == F.lit(str(run_date)).cast("date"))
            .select("city", "state", "junior_jobs", "mid_jobs", "senior_jobs",
                    pct("junior_jobs", "active_jobs").alias("junior_pct"),
                    pct("mid_jobs", "active_jobs").alias("mid_pct"),
                    pct("senior_jobs", "active_jobs").alias("senior_pct"),
                    "active_jobs")
            .orderBy(F.col("active_jobs").desc_nulls_first(), "city", "state").drop("active_jobs"))


def salary_ranges(stats: DataFrame, run_date, min_with_salary: int = 10) -> DataFrame:
    """FLT-5 / NUM-2: rounded salary levels for cities with enough salaried postings."""
    return (stats.where((F.col("run_date") == F.lit(str(run_date)).cast("date"))
                        & (F.col("jobs_with_salary") > min_with_salary))
            .select("city", "state", "jobs_with_salary",
                    F.round("avg_salary_min").alias("avg_min_salary"),
                    F.round("avg_salary_max").alias("avg_max_salary"),
                    F.round("median_salary_min").alias("median_min_salary"),
                    F.round("median_salary_max").alias("median_max_salary"))
            .orderBy(F.col("avg_max_salary").desc_nulls_first(), "city", "state"))


def job_persistence(silver: DataFrame) -> DataFrame:
    """AGG-9: how long postings stay listed, per city."""
    return (silver.where(F.col("source") == "adzuna").groupBy("city", "state_code").agg(
        F.count("*").alias("total_jobs"),
        F.try_divide(F.sum("times_seen").cast("double"), F.count("times_seen")).alias("avg_times_seen"),
        F.count_if(F.col("times_seen") == 1).alias("single_day_jobs"),
        F.count_if(F.col("times_seen") > 7).alias("persistent_jobs"))
        .orderBy(F.desc("total_jobs"), "city", "state_code"))


def avg_days_active(silver: DataFrame) -> DataFrame:
    """AGG-10 / DAT-3: average listed span (days) of active postings, per source."""
    return (silver.where(F.col("is_active")).groupBy("source").agg(
        F.count("*").alias("active_jobs"),
        F.try_divide(F.sum(F.datediff("last_seen", "first_seen")).cast("double"), F.count("*")).alias("avg_days_active")))
