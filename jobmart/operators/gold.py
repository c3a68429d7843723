"""Gold aggregates: per-city daily statistics, latest snapshot, top categories.

All aggregates are partial/final hash aggregations keyed by (city, state_code):
per-task pre-aggregation collapses the rows before the shuffle, so even a
city holding a third of all postings ships one partial row per task. Averages
are ``sum / count`` over exact decimal sums; medians use the distributed exact
median of :mod:`jobmart.operators.quantiles`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobmart import constants as K
from jobmart.functions import text as T
from jobmart.operators.quantiles import grouped_medians, running_medians
from jobmart.sources.tables import checked_broadcast

CITY_KEYS = ["city", "state_code"]


def _date(d) -> Column:
    return F.lit(str(d)).cast("date")


def exact_avg(x: Column) -> Column:
    """AVG over an exact (decimal / integer) sum: one IEEE division, no order noise."""
    return F.try_divide(F.sum(x).cast("double"), F.count(x))


def classify(jobs: DataFrame, run_date) -> DataFrame:
    """silver derived columns as observed: seniority, remote, job type, active flag."""
    return jobs.withColumns({
        "seniority": T.title_seniority("title"),
        "is_remote": T.is_remote("title", "description"),
        "job_type": T.job_type_observed("description"),
        "is_active": F.col("last_seen") == _date(run_date),
    })


def _null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = [left[k].eqNullSafe(r[f"_r_{k}"]) for k in keys]
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])


def _stats_aggs(d: Column) -> list[Column]:
    return [
        F.count("*").alias("total_jobs"),
        F.count_if(F.col("is_active")).alias("active_jobs"),
        F.count_if(F.col("first_seen") == d).alias("new_jobs"),
        F.count_if(~F.col("is_active") & (F.col("last_seen") < d)).alias("expired_jobs"),
        F.count_if(F.col("salary_min").isNotNull()).alias("jobs_with_salary"),
        exact_avg(F.col("salary_min")).alias("avg_salary_min"),
        exact_avg(F.col("salary_max")).alias("avg_salary_max"),
        F.count_if(F.col("is_remote")).alias("remote_jobs"),
        F.count_if(F.col("job_type") == "full-time").alias("fulltime_jobs"),
        F.count_if(F.col("seniority") == "jr").alias("junior_jobs"),
        F.count_if(F.col("seniority") == "mid").alias("mid_jobs"),
        F.count_if(F.col("seniority") == "sr").alias("senior_jobs"),
    ]


STATS_COUNTS = ["total_jobs", "active_jobs", "new_jobs", "expired_jobs", "jobs_with_salary", "avg_salary_min",
                "avg_salary_max", "remote_jobs", "fulltime_jobs", "junior_jobs", "mid_jobs", "senior_jobs"]


def _snapshot_aggs(d: Column) -> list[Column]:
    """Snapshot aggregates except ``active_jobs`` (shared with the stats)."""
    w7, w30 = (F.date_sub(d, n) for n in K.NEW_WINDOWS_DAYS)
    both = F.col("salary_min").isNotNull() & F.col("salary_max").isNotNull()

    def growth(cut: Column) -> Column:
        new, old = F.count_if(F.col("first_seen") >= cut), F.count_if(F.col("first_seen") < cut)
        return F.when(old > 0, new.cast("double") / old * 100).otherwise(F.lit(0.0))

    return [
        F.count_if(F.col("first_seen") >= w7).alias("new_jobs_7d"),
        F.count_if(F.col("first_seen") >= w30).alias("new_jobs_30d"),
        F.try_divide(F.sum(F.when(both, F.col("salary_min") + F.col("salary_max"))).cast("double"),
                     F.count_if(both) * 2).alias("avg_salary"),
        growth(w7).alias("job_growth_rate_7d"),
        growth(w30).alias("job_growth_rate_30d"),
    ]


SNAPSHOT_COUNTS = ["active_jobs", "new_jobs_7d", "new_jobs_30d", "avg_salary", "job_growth_rate_7d",
                   "job_growth_rate_30d"]


def city_aggregates(silver: DataFrame, run_date) -> DataFrame:
    """Every per-city count of both gold tables in one aggregation (one scan of silver)."""
    d = _date(run_date)
    return (silver.where(F.col("source") == "adzuna").groupBy(*CITY_KEYS)
            .agg(*_stats_aggs(d), *_snapshot_aggs(d)))


def city_counts(silver: DataFrame, run_date) -> DataFrame:
    """AGG-1..4: the gold row without its medians; nothing runs while the plan is built."""
    d = _date(run_date)
    counts = silver.where(F.col("source") == "adzuna").groupBy(*CITY_KEYS).agg(*_stats_aggs(d))
    return counts.select("city", F.col("state_code").alias("state"), d.alias("run_date"), *STATS_COUNTS)


def city_job_stats(silver: DataFrame, run_date, counts: DataFrame | None = None) -> DataFrame:
    """AGG-1..5: one row per (city, state) for ``run_date`` over first-source postings.

    ``counts``: precomputed :func:`city_aggregates` (shared with the snapshot). Readers that
    need no median take :func:`city_counts`.
    """
    d = _date(run_date)
    src = silver.where(F.col("source") == "adzuna")
    if counts is None:
        counts = src.groupBy(*CITY_KEYS).agg(*_stats_aggs(d))
    counts = counts.select(*CITY_KEYS, *STATS_COUNTS)
    meds = grouped_medians(src, CITY_KEYS, {"median_salary_min": "salary_min", "median_salary_max": "salary_max"})
    out = _null_safe_join(counts, meds, CITY_KEYS)
    return out.select(
        "city", F.col("state_code").alias("state"), d.alias("run_date"),
        "total_jobs", "active_jobs", "new_jobs", "expired_jobs", "jobs_with_salary",
        "avg_salary_min", "avg_salary_max", "median_salary_min", "median_salary_max",
        "remote_jobs", "fulltime_jobs", "junior_jobs", "mid_jobs", "senior_jobs")


def top_categories(silver: DataFrame, k: int = K.TOP_CATEGORIES) -> DataFrame:
    """AGG-8 / JOIN-7 decorrelated: top-k active categories per (city, state_code), all sources.

    Ties are broken by label ascending; the per-group rank-limit plans as a
    partial + final ``WindowGroupLimit`` after a pre-aggregated count.
    """
    cnt = (silver.where(F.col("is_active") & F.col("category_label").isNotNull())
           .groupBy(*CITY_KEYS, "category_label").agg(F.count("*").alias("cnt")))
    w = Window.partitionBy(*CITY_KEYS).orderBy(F.desc("cnt"), F.asc("category_label"))
    ranked = cnt.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k)
    return ranked.groupBy(*CITY_KEYS).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rn", "category_label"))),
                    lambda x: x["category_label"]).alias("top_categories"))


def latest_city_snapshot(silver: DataFrame, run_date, housing_latest: DataFrame | None = None,
                         counts: DataFrame | None = None, strip_state_suffix: bool = False) -> DataFrame:
    """AGG-6..8: current state per (city, state) with 7/30-day growth and top categories.

    With ``housing_latest`` (``housing.latest_metric``) the declared rent columns
    ``zori_latest``, ``zori_date`` and ``salary_to_rent_ratio`` are filled (JOIN-13).
    ``counts``: precomputed :func:`city_aggregates` (shared with the stats). ``strip_state_suffix``: regions are
    named "Chicago, IL".
    """
    d = _date(run_date)
    if counts is None:
        counts = (silver.where(F.col("source") == "adzuna").groupBy(*CITY_KEYS)
                  .agg(F.count_if(F.col("is_active")).alias("active_jobs"), *_snapshot_aggs(d)))
    snap = counts.select(*CITY_KEYS, *SNAPSHOT_COUNTS)
    tops = top_categories(silver)
    out = snap.join(tops, CITY_KEYS, "left").withColumn(
        "top_categories", F.coalesce(F.col("top_categories"), F.array().cast("array<string>")))
    if housing_latest is not None:
        from jobmart.operators.housing import rent_lookup

        rent = checked_broadcast(rent_lookup(housing_latest, strip_state_suffix).select(
            "_rk", "_rs", F.col("metric_value_latest").cast("double").alias("zori_latest"),
            F.col("date_recorded").cast("date").alias("zori_date")))
        out = (out.join(rent, (T.norm_key("city") == rent._rk) & (F.col("state_code") == rent._rs), "left")
               .drop("_rk", "_rs")
               .withColumn("salary_to_rent_ratio", F.try_divide(F.col("avg_salary"), F.col("zori_latest"))))
    else:
        out = out.withColumns({"zori_latest": F.lit(None).cast("double"), "zori_date": F.lit(None).cast("date"),
                               "salary_to_rent_ratio": F.lit(None).cast("double")})
    return out.select(
        "city", F.col("state_code").alias("state"), "active_jobs", "new_jobs_7d", "new_jobs_30d", "avg_salary",
        "job_growth_rate_7d", "job_growth_rate_30d", "zori_latest", "zori_date", "salary_to_rent_ratio",
        "top_categories")


def _history_sums() -> dict[str, Column]:
    """What a posting adds to its city while it stands: counts and exact salary sums."""
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("bigint")
    return {
        "total_jobs": F.lit(1).cast("bigint"),
        "jobs_with_salary": F.col("salary_min").isNotNull().cast("bigint"),
        "_max_n": F.col("salary_max").isNotNull().cast("bigint"),
        "_min_sum": F.coalesce(F.col("salary_min"), F.lit(0)),
        "_max_sum": F.coalesce(F.col("salary_max"), F.lit(0)),
        "remote_jobs": flag(F.col("is_remote")),
        "fulltime_jobs": flag(F.col("job_type") == "full-time"),
        "junior_jobs": flag(F.col("seniority") == "jr"),
        "mid_jobs": flag(F.col("seniority") == "mid"),
        "senior_jobs": flag(F.col("seniority") == "sr"),
    }


def city_history(versions: DataFrame, first_date, last_date, medians: bool = False) -> DataFrame:
    """The gold row of every (city, state, day) in a range, as it stood on that day.

    ``versions``: one row per posting and day it was sighted (``last_seen`` = that day), with the attributes
    it then had. A version stands from its day until the posting's next one, so each adds its counts and sums
    to its city on one day and takes them back on another; a running sum over the days of a city (one row per
    day) gives the state. Active are the versions of the day, new those whose first sighting it is.
    ``medians`` adds the median salaries of each day, searched in the counts of each salary's changes.
    """
    v = versions.where(F.col("source") == "adzuna")
    nxt = F.lead("last_seen").over(Window.partitionBy("source", "job_id").orderBy("last_seen"))
    v = v.withColumn("_until", nxt)
    sums = _history_sums()
    here = F.struct(F.col("last_seen").alias("day"), F.lit(1).alias("sign"))
    gone = F.when(F.col("_until").isNotNull(), F.struct(F.col("_until").alias("day"), F.lit(-1).alias("sign")))
    moves = v.select("*", F.explode(F.filter(F.array(here, gone), lambda x: x.isNotNull())).alias("_m"))
    starts = F.col("_m.sign") == 1
    days = moves.groupBy(*CITY_KEYS, F.col("_m.day").alias("run_date")).agg(
        *[F.sum(x * F.col("_m.sign")).alias(n) for n, x in sums.items()],
        F.count_if(starts).alias("active_jobs"),
        F.count_if(starts & (F.col("first_seen") == F.col("last_seen"))).alias("new_jobs"))
    first, last = _date(first_date), _date(last_date)
    grid = days.select(*CITY_KEYS).distinct().select(*CITY_KEYS, F.explode(F.sequence(first, last)).alias("run_date"))
    zero = [F.lit(0).cast(t).alias(n) for n, t in days.dtypes if n not in (*CITY_KEYS, "run_date")]
    every = days.unionByName(grid.select(*CITY_KEYS, "run_date", *zero)).groupBy(*CITY_KEYS, "run_date").agg(
        *[F.sum(n).alias(n) for n in (*sums, "active_jobs", "new_jobs")])
    w = Window.partitionBy(*CITY_KEYS).orderBy("run_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    state = every.withColumns({n: F.sum(n).over(w) for n in sums})
    state = state.where((F.col("run_date") >= first) & (F.col("run_date") <= last) & (F.col("total_jobs") > 0))
    out = state.withColumns({
        "expired_jobs": F.col("total_jobs") - F.col("active_jobs"),
        "avg_salary_min": F.try_divide(F.col("_min_sum").cast("double"), F.col("jobs_with_salary")),
        "avg_salary_max": F.try_divide(F.col("_max_sum").cast("double"), F.col("_max_n"))})
    if medians:
        meds = running_medians(v.withColumn("_from", F.col("last_seen")), CITY_KEYS,
                               {"median_salary_min": "salary_min", "median_salary_max": "salary_max"}, first, last)
        out = _null_safe_join(out, meds, [*CITY_KEYS, "run_date"])
    cols = ["total_jobs", "active_jobs", "new_jobs", "expired_jobs", "jobs_with_salary", "avg_salary_min", "avg_salary_max",
            *(["median_salary_min", "median_salary_max"] if medians else []), "remote_jobs", "fulltime_jobs", "junior_jobs", "mid_jobs", "senior_jobs"]
    return out.select("city", F.col("state_code").alias("state"), "run_date", *cols)
