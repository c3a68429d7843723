"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the driver tables through the adapter, so its work grows
with the scale factor. Column names match :mod:`jobmart.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmart import constants as K
from jobmart.functions import text as T
from jobmart.operators import analysis, calls, gold, housing, lifecycle, maintenance
from jobmart.operators import silver as silver_ops
from jobmart.sources import adapter
from jobmart.sources.tables import write_table

RUN = K.FIXTURE_RUN_DATE
Query = Callable[[SparkSession, str], DataFrame]


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The adapter's postings, landed once per application as a parquet table.

    Downstream jobs read it like the stored silver table they read in
    production: the scan prunes columns, and the fixture's join/CASE projection
    is not fused into (and recomputed by) every classifier plan. It is written in
    as many files as the session has shuffle partitions, so that all cores read it.
    """
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return write_table(lambda: adapter.postings(spark, sf_dir, RUN).repartition(files, "job_id"), "postings", (sf_dir, RUN), spark)


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """silver.jobs_v2 as of the fixture run date (J + observed classifications)."""
    return gold.classify(postings(spark, sf_dir), RUN)


def q_city_job_stats(spark, sf_dir):
    return gold.city_job_stats(silver(spark, sf_dir), RUN)


def q_latest_city_snapshot(spark, sf_dir):
    snap = gold.latest_city_snapshot(silver(spark, sf_dir), RUN)
    return snap.select("city", "state", "active_jobs", "new_jobs_7d", "new_jobs_30d", "avg_salary",
                       "job_growth_rate_7d", "job_growth_rate_30d",
                       F.array_join("top_categories", "|").alias("top_categories"))


def q_top_cities_active(spark, sf_dir):
    return analysis.top_cities_active(gold.latest_city_snapshot(silver(spark, sf_dir), RUN))


def q_remote_share(spark, sf_dir):
    return analysis.remote_share(gold.city_counts(silver(spark, sf_dir), RUN), RUN)


def q_seniority_distribution(spark, sf_dir):
    return analysis.seniority_distribution(gold.city_counts(silver(spark, sf_dir), RUN), RUN)


def q_salary_ranges(spark, sf_dir):
    return analysis.salary_ranges(gold.city_job_stats(silver(spark, sf_dir), RUN), RUN)


def q_job_persistence(spark, sf_dir):
    return analysis.job_persistence(silver(spark, sf_dir))


def q_avg_days_active(spark, sf_dir):
    return analysis.avg_days_active(silver(spark, sf_dir))


# --- sightings (E) --------------------------------------------------------------------

SPLIT_DAY = "2024-01-15"
ORDER = ["ts", "event_id"]


def q_lifecycle_batch(spark, sf_dir):
    return lifecycle.fold_sightings(adapter.sightings(spark, sf_dir))


def q_lifecycle_upsert(spark, sf_dir):
    e = adapter.sightings(spark, sf_dir)
    first = lifecycle.upsert_sightings(lifecycle.empty_target(spark), e.where(F.col("run_date") <= SPLIT_DAY), ORDER)
    return lifecycle.upsert_sightings(first.drop("changed"), e, ORDER).drop("changed")


def q_lifecycle_refresh(spark, sf_dir):
    e = adapter.sightings(spark, sf_dir)
    first = lifecycle.upsert_sightings(lifecycle.empty_target(spark), e.where(F.col("run_date") <= SPLIT_DAY),
                                       ORDER, refresh_payload=True)
    return lifecycle.upsert_sightings(first.drop("changed"), e, ORDER, refresh_payload=True).drop("changed")


def _v1_batch(e):
    return e.select("source", "job_id", F.col("run_date").alias("fetched_at"), "payload", "ts", "event_id")


def q_insert_ignore(spark, sf_dir):
    e = _v1_batch(adapter.sightings(spark, sf_dir))
    empty = spark.createDataFrame([], "job_id string, fetched_at date, source string, payload string")
    first = lifecycle.insert_ignore(empty, e.where(F.col("ts") < F.lit(SPLIT_DAY + " 12:00:00").cast("timestamp")), ORDER)
    return lifecycle.insert_ignore(first, e, ORDER)


def q_latest_version(spark, sf_dir):
    e = adapter.sightings(spark, sf_dir)
    empty = spark.createDataFrame([], "job_id string, fetched_at date, source string, payload string")
    bronze_v1 = lifecycle.insert_ignore(empty, _v1_batch(e), ORDER)
    enriched = lifecycle.fold_sightings(e.where(F.col("run_date") < "2024-01-02"))
    return lifecycle.not_in_silver(lifecycle.latest_version(bronze_v1), enriched, "adzuna")


def _calls(spark, sf_dir):
    e = adapter.pull_runs(adapter.sightings(spark, sf_dir))
    credited = calls.new_per_pull(e)
    t = calls.empty_calls(spark)
    for run in (0, 1):
        t = calls.upsert_calls(t, calls.calls_batch(e.where(F.col("run") == run),
                                                    credited.where(F.col("run") == run).drop("run")))
    return t


def q_job_calls_upsert(spark, sf_dir):
    return _calls(spark, sf_dir)


def q_job_calls_consolidate(spark, sf_dir):
    return calls.consolidate(adapter.page_log(spark, sf_dir))


def q_job_calls_duplicates(spark, sf_dir):
    return calls.duplicate_rows(adapter.page_log(spark, sf_dir))


def q_job_calls_keep_latest(spark, sf_dir):
    return calls.keep_latest(adapter.page_log(spark, sf_dir), ["pulled_at", "event_id"])


def q_missing_pulls(spark, sf_dir):
    return calls.missing_pulls(adapter.sightings(spark, sf_dir), _calls(spark, sf_dir), list(adapter.ROLES))


def q_market_size(spark, sf_dir):
    return calls.market_size(_calls(spark, sf_dir))


# --- payload enrichment (bronze -> silver) --------------------------------------------

PREV_DAY = "2001-07-31"
SILVER_OUT = ["source", "job_id", "title", "description", "company", "location", "city", "county", "state",
              "state_code", "category", "category_label", "salary_min", "salary_max", "post_date", "url",
              "first_seen", "last_seen", "times_seen", "is_active", "seniority", "is_remote", "job_type"]


def bronze(spark, sf_dir):
    """bronze.raw_jobs for the run date, landed once as a parquet table."""
    return write_table(lambda: adapter.raw_jobs(postings(spark, sf_dir)), "bronze_raw_jobs", (sf_dir, RUN), spark)


def _silver_out(df):
    return df.select(*[F.col(c).cast("double").alias(c) if c.startswith("salary_") else F.col(c) for c in SILVER_OUT])


def q_enrich_payload(spark, sf_dir):
    raw = bronze(spark, sf_dir).where(F.col("source") == "adzuna")
    good, _ = silver_ops.split_valid(silver_ops.enrich_first_source(raw, RUN))
    return _silver_out(good)


def q_enrich_rejects(spark, sf_dir):
    raw = bronze(spark, sf_dir).where(F.col("source") == "adzuna")
    return silver_ops.split_valid(silver_ops.enrich_first_source(raw, RUN))[1]


def silver_prev(spark, sf_dir):
    """Silver as it stood the day before, landed once like the stored table it stands for."""
    def build():
        raw_prev = adapter.raw_jobs_as_of(bronze(spark, sf_dir), PREV_DAY).where(F.col("source") == "adzuna")
        return silver_ops.split_valid(silver_ops.enrich_first_source(raw_prev, PREV_DAY))[0]
    return write_table(build, "silver_prev", (sf_dir, PREV_DAY), spark)


def second_source_bronze(spark, sf_dir):
    """The second source's landed records, written once."""
    return write_table(lambda: adapter.jsearch_raw(postings(spark, sf_dir)), "jsearch_raw", (sf_dir, RUN), spark)


def q_incremental_work_set(spark, sf_dir):
    ws = silver_ops.work_set(bronze(spark, sf_dir), silver_prev(spark, sf_dir))
    return ws.select("source", "job_id", "first_seen", "last_seen", "times_seen")


def q_silver_upsert(spark, sf_dir):
    new, _ = silver_ops.enrich_run(bronze(spark, sf_dir), silver_prev(spark, sf_dir), RUN)
    return _silver_out(new)


V1_OUT = ["source", "job_id", "title", "company", "location", "city", "county", "state", "category", "description",
          "post_date", "url", "salary_min", "salary_max", "seniority", "is_remote", "job_type"]


def _v1_first(spark, sf_dir):
    raw = bronze(spark, sf_dir).where(F.col("source") == "adzuna")
    return silver_ops.split_valid(silver_ops.enrich_first_source_v1(raw))[0].select(*V1_OUT)


def _v1_second(spark, sf_dir):
    return silver_ops.split_valid(silver_ops.enrich_second_source(second_source_bronze(spark, sf_dir), RUN))[0] \
        .select(*V1_OUT)


def q_adzuna_v1_enrich(spark, sf_dir):
    return _v1_first(spark, sf_dir)


def q_jsearch_enrich(spark, sf_dir):
    return _v1_second(spark, sf_dir)


def q_silver_v1(spark, sf_dir):
    return silver_ops.silver_v1(_v1_first(spark, sf_dir), _v1_second(spark, sf_dir))


# --- housing ------------------------------------------------------------------------------

def housing_wide(spark, sf_dir):
    """The landed wide CSV (written once from the adapter, read back with its header)."""
    import os

    from jobmart.session import shared_dir

    key = ("housing_csv", sf_dir)
    path = _LANDED_PATHS.get(key)
    if path is None:
        import uuid

        path = os.path.join(shared_dir(spark), f"zillow_wide-{uuid.uuid4().hex}")
        adapter.housing_wide(spark, sf_dir).write.option("header", True).csv(path)
        _LANDED_PATHS[key] = path
    return housing.read_wide_csv(spark, path, infer=False)


_LANDED_PATHS: dict = {}


def housing_latest(spark, sf_dir):
    return housing.latest_metric(housing_wide(spark, sf_dir), "zillow_zori", "rent_index_latest")


def q_housing_latest(spark, sf_dir):
    return housing_latest(spark, sf_dir).drop("cbsa_code")


def q_housing_long(spark, sf_dir):
    return housing.long_history(housing_wide(spark, sf_dir), "zillow_zori", "rent_index")


def q_city_mapping(spark, sf_dir):
    return housing.city_mapping(silver(spark, sf_dir), housing_latest(spark, sf_dir))


def q_affordability(spark, sf_dir):
    snap = gold.latest_city_snapshot(silver(spark, sf_dir), RUN, housing_latest(spark, sf_dir))
    return housing.affordability(snap)


def q_cbsa_lookup(spark, sf_dir):
    return housing.cbsa_codes(silver(spark, sf_dir), adapter.cbsa_lookup(spark, sf_dir))


# --- classifiers ------------------------------------------------------------------------

def q_classify_postings(spark, sf_dir):
    j = postings(spark, sf_dir).select(
        "*", T.yoe_match(T.joined_lower("title", "description")).alias("_yoe_txt"),
        T.yoe_match("description").alias("_yoe_raw"), T.yoe_match(F.lower("description")).alias("_yoe_low"))
    return j.select(
        "source", "job_id",
        T.title_seniority("title").alias("seniority"),
        T.categorize_role_documented("title", "description", "salary_min", "salary_max", "_yoe_raw")
        .alias("seniority_documented"),
        T.seniority_v1("title", "description", "_yoe_txt").alias("seniority_v1"),
        T.salary_band("salary_min", "salary_max").alias("salary_band"),
        T.yoe_years(None, "_yoe_low").alias("yoe_min"),
        T.yoe_band(None, "_yoe_low").alias("yoe_band"),
        T.is_remote("title", "description").alias("is_remote"),
        T.job_type_observed("description").alias("job_type"),
        T.job_type_documented("title", "description").alias("job_type_documented"))


def q_classify_documents(spark, sf_dir):
    from jobmart.sources.tables import table

    d = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    # What several classifiers read is computed once: the lower-cased text and the years of experience in it.
    d = d.withColumn("_low", F.lower(F.coalesce("text", F.lit("")))).withColumn("_yoe", T.yoe_match("_low"))
    return d.select("doc_id", T.title_seniority("text").alias("seniority"),
                    T.categorize_role_documented("text", "text", F.lit(None), F.lit(None), "_yoe").alias("seniority_documented"),
                    T.seniority_v1("text", F.lit(None), "_yoe").alias("seniority_v1"),
                    T.is_remote("text", F.lit(None)).alias("is_remote"),
                    T.yoe_years(None, "_yoe").alias("yoe_min"),
                    T.yoe_band(None, "_yoe").alias("yoe_band"),
                    T.job_type_observed("text").alias("job_type"),
                    T.job_type_documented("text", "text").alias("job_type_documented"),
                    T.industry("text", "text").alias("industry"),
                    T.industry_hint("text", F.lit(None), "source").alias("industry_hint"),
                    T.education("text").alias("education"))


def q_industry(spark, sf_dir):
    j = postings(spark, sf_dir)
    # Only companies the startup rule can name need their count; no other posting is shuffled.
    named = F.coalesce(T.startup_company("company"), F.lit(False))
    per_company = j.where(named).groupBy("company").agg(F.count("*").alias("company_postings"))
    jj = (j.where(named).join(per_company, "company", "left")
          .unionByName(j.where(~named).withColumn("company_postings", F.lit(None).cast("bigint"))))
    return jj.select("source", "job_id", T.industry("title", "company", "company_postings").alias("industry"))


def q_industry_hints(spark, sf_dir):
    j = postings(spark, sf_dir)
    return j.select("source", "job_id",
                    T.industry_hint("title", "description", "category_label").alias("industry_hint"),
                    T.education("description").alias("education"))


def q_state_abbrev(spark, sf_dir):
    j = postings(spark, sf_dir)
    vals = j.select(F.explode(F.array(
        "state", F.lower("state"), F.upper("state"), F.concat(F.lit("  "), "state", F.lit(" ")),
        F.substring("state", 1, 2), F.upper(F.substring("state", 1, 2)), "state_code")).alias("state_input")).distinct()
    return vals.select("state_input", T.state_abbreviation("state_input").alias("state_abbrev"))


def q_location(spark, sf_dir):
    j = postings(spark, sf_dir)
    raw = F.concat_ws(", ", "city", "state_code")
    county = F.when(F.col("source") == "adzuna", F.lit("County")).otherwise(F.lit(None))
    return j.select("source", "job_id",
                    T.standardize_location("city", county, "state", raw, "source").alias("location"),
                    T.standardize_county(county, "source").alias("county"))


# --- maintenance / data quality ---------------------------------------------------------------

def _seniority_changes(spark, sf_dir):
    j = postings(spark, sf_dir).withColumn(
        "_yoe", T.yoe_match(T.joined_lower("title", "description")))
    old = F.when(F.col("description") != "", T.seniority_v1("title", "description", "_yoe"))
    return maintenance.seniority_changes(j.withColumn("seniority", old), T.title_seniority("title"))


def q_seniority_backfill_matrix(spark, sf_dir):
    return maintenance.transition_matrix(_seniority_changes(spark, sf_dir))


def q_seniority_backfill_sample(spark, sf_dir):
    return maintenance.change_sample(_seniority_changes(spark, sf_dir))


def q_description_backfill(spark, sf_dir):
    raw = bronze(spark, sf_dir)
    good, _ = silver_ops.split_valid(silver_ops.enrich_first_source(raw.where(F.col("source") == "adzuna"), RUN))
    return maintenance.description_backfill(_two_of_three_blank(good), raw)[1]


def _two_of_three_blank(good):
    return good.withColumn("description", F.when(F.col("job_id").cast("bigint") % 3 == 0, F.concat(F.lit("kept "), "description")))


def q_description_backfill_table(spark, sf_dir):
    raw = bronze(spark, sf_dir)
    good, _ = silver_ops.split_valid(silver_ops.enrich_first_source(raw.where(F.col("source") == "adzuna"), RUN))
    return maintenance.description_backfill(_two_of_three_blank(good), raw)[0].select("source", "job_id", "description")


def q_dq_report(spark, sf_dir):
    s = silver(spark, sf_dir)
    stats = gold.city_counts(s, RUN)
    return maintenance.dq_report(
        {"silver.jobs_v2": (s, ["source", "job_id"], ["source", "job_id", "title", "first_seen", "last_seen"]),
         "gold.city_job_stats": (stats, ["city", "state", "run_date"],
                                 ["city", "state", "run_date", "total_jobs", "active_jobs", "new_jobs", "expired_jobs"])},
        {"silver.jobs_v2": {"seniority": ["jr", "mid", "sr"]}})


def q_posting_trends(spark, sf_dir):
    return maintenance.posting_trends(silver(spark, sf_dir))


def _history(spark, sf_dir):
    """City history over every day of the sighting log."""
    v = write_table(lambda: adapter.posting_versions(spark, sf_dir), "versions", (sf_dir,), spark)
    first, last = v.agg(F.min("last_seen"), F.max("last_seen")).first()
    return gold.city_history(v, first, last)


def q_wow_change(spark, sf_dir):
    h = _history(spark, sf_dir).select("city", "state", "run_date", "active_jobs")
    h = maintenance.period_change(h, "active_jobs", 7, "week_over_week_change")
    return maintenance.period_change(h, "active_jobs", 30, "month_over_month_change")


def q_city_trend(spark, sf_dir):
    return analysis.city_trend(_history(spark, sf_dir))


def q_city_history(spark, sf_dir):
    return _history(spark, sf_dir)


def q_filter_new(spark, sf_dir):
    e = adapter.sightings(spark, sf_dir)
    day = e.where(F.col("run_date") == SPLIT_DAY)
    stored = lifecycle.fold_sightings(e.where(F.col("run_date") <= SPLIT_DAY).where(F.hour("ts") < 12))
    return lifecycle.filter_new(day.select("job_id", "event_id"), stored, "adzuna", SPLIT_DAY)


def q_second_source_pages(spark, sf_dir):
    from jobmart.sources import pages

    recs = pages.page_records(adapter.landed_second_pages(postings(spark, sf_dir), RUN), "$.data", source="jsearch")
    return recs.select("run_date", "city", "role", "page", "source", "job_id", F.get_json_object("payload", "$.job_title").alias("title"))


def q_city_score_inputs(spark, sf_dir):
    return maintenance.city_score_inputs(gold.city_counts(silver(spark, sf_dir), RUN), housing_latest(spark, sf_dir))


def q_restamp_stale(spark, sf_dir):
    e = adapter.sightings(spark, sf_dir).select("event_id", F.col("ts").alias("processed_at"))
    out = lifecycle.restamp_stale(e, "processed_at", "2024-01-15 12:00:00")
    return out.withColumn("fetched_today", F.to_date("processed_at") == F.lit("2024-01-15").cast("date"))


# --- landed pages -----------------------------------------------------------------------------

def landed(spark, sf_dir):
    """The page log as landed files (JSON lines), read back through the page reader."""
    import os
    import uuid

    from jobmart.session import shared_dir
    from jobmart.sources import pages

    key = ("landed_pages", sf_dir)
    path = _LANDED_PATHS.get(key)
    if path is None:
        path = os.path.join(shared_dir(spark), f"landed_pages-{uuid.uuid4().hex}")
        adapter.landed_pages(postings(spark, sf_dir), RUN).write.json(path)
        _LANDED_PATHS[key] = path
    return pages.read_landed(spark, path)


def q_page_cutoff(spark, sf_dir):
    from jobmart.sources import pages

    return pages.page_records(landed(spark, sf_dir), max_pages=K.MAX_PAGES).select("run_date", "city", "role", "page", "job_id")


def q_page_pulls(spark, sf_dir):
    from jobmart.sources import pages

    return pages.pull_summary(landed(spark, sf_dir))


def q_seen_today(spark, sf_dir):
    return lifecycle.seen_on(bronze(spark, sf_dir), "adzuna", RUN)


def q_v1_envelope(spark, sf_dir):
    from jobmart.sources import pages

    rows = pages.to_v1_rows(pages.page_records(landed(spark, sf_dir)))
    return rows.select("source", "job_id", "fetched_at", "page", "position",
                       F.get_json_object("payload", "$.id").alias("payload_id"),
                       F.get_json_object("payload", "$.title").alias("payload_title"),
                       F.get_json_object("payload", "$.location.area[3]").alias("payload_city"),
                       F.get_json_object("payload", "$.salary_max").cast("double").alias("payload_salary_max"))


def q_run_report(spark, sf_dir):
    from jobmart.sources import pages

    recs = pages.page_records(landed(spark, sf_dir))
    return maintenance.run_report(bronze(spark, sf_dir), pages.to_v1_rows(recs),
                                  recs.select("run_date", "city", "role").distinct(), RUN)


# --- stored outcomes of the jobs -----------------------------------------------------------------

def _scratch_root(spark) -> str:
    import os
    import uuid

    from jobmart.session import shared_dir

    return os.path.join(shared_dir(spark), f"store-{uuid.uuid4().hex}")


def q_stored_bronze(spark, sf_dir):
    """PIP-1 / STM-1 / SNK-4: bronze as two streams leave it, each with a batch 0, one of them folded into a snapshot."""
    from jobmart.plans import jobs

    root, pages_ = _scratch_root(spark), landed(spark, sf_dir)
    first = F.crc32(F.concat("city", "role")) % 2 == 0
    jobs.ingest_pages(spark, pages_.where(first), root, 0, "a")
    jobs.compact_bronze(spark, root)
    jobs.ingest_pages(spark, pages_.where(~first), root, 0, "b")
    return jobs.bronze_current(spark, root).select("source", "job_id", "first_seen", "last_seen", "times_seen")


def q_stored_calls(spark, sf_dir):
    """PIP-9 / SNK-6: the pull audit after an earlier page log was imported, twice."""
    from jobmart.plans import jobs

    root, log = _scratch_root(spark), adapter.page_log(spark, sf_dir)
    jobs.import_calls(spark, root, log, "pages")
    return jobs.import_calls(spark, root, log, "pages")


def q_stored_calls_latest(spark, sf_dir):
    """PIP-10: the pull audit after a log with several rows for a pull was imported; the latest stays."""
    from jobmart.plans import jobs

    log = adapter.page_log(spark, sf_dir).withColumn("pages_fetched", F.lit(1))
    return jobs.import_calls(spark, _scratch_root(spark), log, "pulls", per_page=False)


# SURVEY §7.3 names for single classifier families (projections of the operators above).
SUBSETS = {
    "classify_titles": ("classify_postings", ["source", "job_id", "seniority", "seniority_documented", "seniority_v1"]),
    "classify_yoe": ("classify_postings", ["source", "job_id", "yoe_min", "yoe_band"]),
    "classify_salary": ("classify_postings", ["source", "job_id", "salary_band"]),
    "job_type": ("classify_postings", ["source", "job_id", "job_type", "job_type_documented"]),
    "is_remote": ("classify_postings", ["source", "job_id", "is_remote"]),
    "education": ("industry_hints", ["source", "job_id", "education"]),
    "mark_inactive": ("silver_upsert", ["source", "job_id", "last_seen", "is_active"]),
}


def _subset(base: str, cols: list[str]) -> Query:
    def q(spark, sf_dir):
        return _BASES[base](spark, sf_dir).select(*cols)
    return q


def queries() -> dict[str, Query]:
    return {
        "city_job_stats": q_city_job_stats,
        "latest_city_snapshot": q_latest_city_snapshot,
        "top_cities_active": q_top_cities_active,
        "remote_share": q_remote_share,
        "seniority_distribution": q_seniority_distribution,
        "salary_ranges": q_salary_ranges,
        "job_persistence": q_job_persistence,
        "avg_days_active": q_avg_days_active,
        "lifecycle_batch": q_lifecycle_batch,
        "lifecycle_upsert": q_lifecycle_upsert,
        "lifecycle_refresh": q_lifecycle_refresh,
        "insert_ignore": q_insert_ignore,
        "latest_version": q_latest_version,
        "job_calls_upsert": q_job_calls_upsert,
        "job_calls_consolidate": q_job_calls_consolidate,
        "job_calls_duplicates": q_job_calls_duplicates,
        "job_calls_keep_latest": q_job_calls_keep_latest,
        "missing_pulls": q_missing_pulls,
        "market_size": q_market_size,
        "enrich_payload": q_enrich_payload,
        "enrich_rejects": q_enrich_rejects,
        "incremental_work_set": q_incremental_work_set,
        "silver_upsert": q_silver_upsert,
        "adzuna_v1_enrich": q_adzuna_v1_enrich,
        "jsearch_enrich": q_jsearch_enrich,
        "silver_v1": q_silver_v1,
        "housing_latest": q_housing_latest,
        "housing_long": q_housing_long,
        "city_mapping": q_city_mapping,
        "affordability": q_affordability,
        "cbsa_lookup": q_cbsa_lookup,
        "classify_postings": q_classify_postings,
        "classify_documents": q_classify_documents,
        "industry": q_industry,
        "industry_hints": q_industry_hints,
        "state_abbrev": q_state_abbrev,
        "location": q_location,
        "seniority_backfill_matrix": q_seniority_backfill_matrix,
        "seniority_backfill_sample": q_seniority_backfill_sample,
        "description_backfill": q_description_backfill,
        "description_backfill_table": q_description_backfill_table,
        "dq_report": q_dq_report,
        "posting_trends": q_posting_trends,
        "wow_change": q_wow_change,
        "city_trend": q_city_trend,
        "city_history": q_city_history,
        "filter_new": q_filter_new,
        "second_source_pages": q_second_source_pages,
        "city_score_inputs": q_city_score_inputs,
        "restamp_stale": q_restamp_stale,
        "page_cutoff": q_page_cutoff,
        "page_pulls": q_page_pulls,
        "seen_today": q_seen_today,
        "v1_envelope": q_v1_envelope,
        "run_report": q_run_report,
        "stored_bronze": q_stored_bronze,
        "stored_calls": q_stored_calls,
        "stored_calls_latest": q_stored_calls_latest,
        **{name: _subset(base, cols) for name, (base, cols) in SUBSETS.items()},
    }


_BASES = {"classify_postings": q_classify_postings, "industry_hints": q_industry_hints,
          "silver_upsert": q_silver_upsert}
