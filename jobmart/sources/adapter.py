"""Adapter: job-market shapes derived from the driver's TPC-H-ish tables.

* ``postings`` (J): one posting per order (orders ⋈ customer ⋈ nation ⋈ region)
  with title / description / company drawn from fixed lists by key, salary from
  the order price, sighting dates from the order date.
* ``sightings`` (E): one sighting per event, job = user, day = event date.
* ``housing_wide`` (H): one wide housing row per nation, a column per month
  holding the average shipped price of that nation's suppliers / 30.

All expressions are native Columns, so the adapter is a plain scan → join →
project plan; nation/region (25 / 5 rows by schema) are broadcast after a
size check, customer ⋈ orders is a keyed shuffle join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmart import constants as K
from jobmart.functions import text as T
from jobmart.sources.tables import checked_broadcast, table


def keyword_titles(words: tuple[str, ...] = ("bridge", "inspector")) -> tuple[str, ...]:
    """Fixture titles, made from the title classifier's keywords: one per keyword, and one without any.

    Titles take turns in where the keyword stands (first, between the words, last, grown into a word) and in case.
    """
    tags = ("", *K.SENIOR_TITLE_TAGS, *K.MID_TITLE_TAGS, *K.JUNIOR_TITLE_TAGS)
    cases = (str.title, str.lower, str.upper, str.capitalize, str.swapcase)
    out = []
    for i, tag in enumerate(tags):
        place = i % 4
        parts = [*words[:place], tag, *words[place:]] if place < 3 else [words[0], words[1] + tag]
        out.append(cases[i % len(cases)](" ".join(p for p in parts if p)))
    return tuple(out)


# Fixture lists, indexed by key modulo length.
TITLES = keyword_titles()
DESCRIPTIONS = ("Fully remote role, 3-5 years experience", "At least 7 years required",
                "Internal tools team, part time", "Minimum of 4 years. Contract position",
                "Work from home, 2+ yrs", "", "3 to 5 years, bachelor degree")
COMPANIES = ("Google LLC", "JPMorgan Chase", "Deloitte Consulting", "Pfizer", "Stripe", "City Hospital")
STATE_NAMES = ("Illinois", "Michigan")  # by c_nationkey % 3; else the nation name


def _pick(key: Column, values, default: Column | None = None) -> Column:
    """values[key % len] (or ``default`` for residues beyond the list)."""
    n = len(values) + (1 if default is not None else 0)
    idx = (key % n).cast("int")
    out = F.when(idx == 0, F.lit(values[0]))
    for i, v in enumerate(values[1:], start=1):
        out = out.when(idx == i, F.lit(v))
    return out.otherwise(default) if default is not None else out


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region", "r_regionkey", "r_name")
    return checked_broadcast(n.join(checked_broadcast(r), n.n_regionkey == r.r_regionkey)
                             .select("n_nationkey", "n_name", "r_name"))


def postings(spark: SparkSession, sf_dir: str, run_date: str = K.FIXTURE_RUN_DATE) -> DataFrame:
    """J: the silver-shaped posting rows (without derived classifications)."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    c = table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    j = o.join(c, o.o_custkey == c.c_custkey).join(_nations(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"))
    k = F.col("o_orderkey")
    first_seen = F.col("o_orderdate").cast("date")
    day_before = F.date_sub(F.lit(run_date).cast("date"), 1)
    last_seen = F.when(k % 3 == 0, F.lit(run_date).cast("date")).otherwise(
        F.greatest(first_seen, F.least(F.date_add(first_seen, (k % 30).cast("int")), day_before)))
    pending = F.col("o_orderstatus") == "P"
    return j.select(
        F.when(k % 5 == 0, "jsearch").otherwise("adzuna").alias("source"),
        k.cast("string").alias("job_id"),
        _pick(k, TITLES).alias("title"),
        _pick(k, DESCRIPTIONS).alias("description"),
        _pick(F.col("o_custkey"), COMPANIES, F.col("c_name")).alias("company"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state_code"),
        _pick(F.col("c_nationkey"), STATE_NAMES, F.col("n_name")).alias("state"),
        F.col("c_mktsegment").alias("category_label"),
        F.when(pending, None).otherwise(F.floor(F.col("o_totalprice") * 0.5).cast("decimal(12,2)")).alias("salary_min"),
        F.when(pending, None).otherwise(F.col("o_totalprice").cast("decimal(12,2)")).alias("salary_max"),
        first_seen.alias("first_seen"),
        last_seen.alias("last_seen"),
        (k % 30 + 1).cast("int").alias("times_seen"),
    )


def posting_payload(j: DataFrame) -> Column:
    """The first-source JSON record for a J row (absent keys for NULL salaries)."""
    return F.to_json(F.struct(
        F.col("job_id").alias("id"),
        F.col("title"),
        F.col("description"),
        F.concat(F.col("first_seen").cast("string"), F.lit("T10:00:00Z")).alias("created"),
        F.concat(F.lit("https://jobs.example/"), F.col("job_id")).alias("redirect_url"),
        F.col("salary_min").cast("double").alias("salary_min"),
        F.col("salary_max").cast("double").alias("salary_max"),
        F.struct(F.col("company").alias("display_name")).alias("company"),
        F.struct(F.lower(F.col("category_label")).alias("tag"), F.col("category_label").alias("label")).alias("category"),
        F.struct(
            F.concat_ws(", ", F.col("city"), F.col("state")).alias("display_name"),
            F.array(F.lit("US"), F.col("state"), F.lit("County"), F.col("city")).alias("area"),
        ).alias("location"),
    ))


# Defect kinds injected into the landed payloads, chosen by o_orderkey % DEFECT_MOD:
# 0 malformed JSON, 1 JSON-null title, 2 JSON-null description, 3 area of length 2,
# 4 area of length 3, 5 unparsable created, 6 JSON-null location, 7 absent title; then the
# text replacements of TEXT_DEFECTS.
DEFECT_MOD = 97
# defect -> (pattern, replacement) on the record text: JSON-null leaves, wrong types, numeric
# date, a salary with three decimals, a salary no table column can hold.
TEXT_DEFECTS = {
    8: ('"display_name":"[^"]*"', '"display_name":null'), 9: (r'"company":\{[^}]*\}', '"company":"Acme"'),
    10: (r'"category":\{[^}]*\}', '"category":["it"]'), 11: (r'"location":\{.*$', '"location":"here"}'),
    12: ('"created":"[^"]*"', '"created":20010731'), 13: ('"salary_max":[^,]*', '"salary_max":54321.987'),
    14: ('"salary_max":[^,]*', '"salary_max":1e30'),
}


def _payload_struct(j: DataFrame, defect: Column) -> Column:
    area_full = F.array(F.lit("US"), F.col("state"), F.lit("County"), F.col("city"))
    area = (F.when(defect == 3, F.slice(area_full, 1, 2)).when(defect == 4, F.slice(area_full, 1, 3))
            .otherwise(area_full))
    created = F.when(defect == 5, F.lit("not-a-date")).otherwise(
        F.concat(F.col("first_seen").cast("string"), F.lit("T10:00:00Z")))
    location = F.when(defect == 6, F.lit(None)).otherwise(F.struct(
        F.concat_ws(", ", F.col("city"), F.col("state")).alias("display_name"), area.alias("area")))
    return F.struct(
        F.col("job_id").alias("id"),
        F.when(defect == 1, F.lit(None)).otherwise(F.col("title")).alias("title"),
        F.when(defect == 2, F.lit(None)).otherwise(F.col("description")).alias("description"),
        created.alias("created"),
        F.concat(F.lit("https://jobs.example/"), F.col("job_id")).alias("redirect_url"),
        F.col("salary_min").cast("double").alias("salary_min"),
        F.col("salary_max").cast("double").alias("salary_max"),
        F.struct(F.col("company").alias("display_name")).alias("company"),
        F.struct(F.lower(F.col("category_label")).alias("tag"), F.col("category_label").alias("label")).alias("category"),
        location.alias("location"),
    )


def raw_jobs(postings_df: DataFrame) -> DataFrame:
    """bronze.raw_jobs built from J: key, lifecycle columns and the landed JSON payload.

    Defect rows carry JSON nulls, a dropped title key, or a truncated document.
    """
    j = postings_df
    defect = (F.col("job_id").cast("bigint") % DEFECT_MOD).cast("int")
    j = j.select("source", "job_id", "first_seen", "last_seen", "times_seen", defect.alias("_d"),
                 _payload_struct(j, defect).alias("_st"))
    # One JSON writer for every row; NULLs are written as JSON null (read like absent keys
    # for salaries), the absent-title case removes the key from the text.
    j = j.withColumn("_js", F.to_json(F.col("_st"), {"ignoreNullFields": "false"}))
    js, d = F.col("_js"), F.col("_d")
    payload = (F.when(d == 0, F.substring(js, 1, 25))
               .when(d == 7, F.regexp_replace(js, r'"title":"[^"]*",', "")))
    for n, (pattern, text) in TEXT_DEFECTS.items():
        payload = payload.when(d == n, F.regexp_replace(js, pattern, text))
    payload = payload.otherwise(js)
    return j.select("source", "job_id", "first_seen", "last_seen", "times_seen", payload.alias("payload"))


def jsearch_raw(postings_df: DataFrame) -> DataFrame:
    """Second-source bronze rows (source jsearch) with the second-source record shape."""
    j = postings_df.where(F.col("source") == "jsearch")
    k = F.col("job_id").cast("bigint")
    state_field = F.when(k % 4 == 0, F.lit("")).when(k % 4 == 1, F.col("state")).otherwise(F.col("state_code"))
    location = F.when(k % 3 == 0, F.concat_ws(", ", F.col("city"), F.lit("IL"))).otherwise(F.col("city"))
    rec = F.struct(
        F.col("job_id").alias("job_id"),
        F.when(k % 31 != 0, F.col("title")).alias("job_title"),  # JSON null for every 31st
        F.col("description").alias("job_description"),
        F.col("company").alias("employer_name"),
        location.alias("job_location"),
        F.col("city").alias("job_city"),
        state_field.alias("job_state"),
        F.col("category_label").alias("employer_company_type"),
        F.concat(F.lit("https://apply.example/"), F.col("job_id")).alias("job_apply_link"),
        F.col("salary_min").cast("double").alias("job_min_salary"),
        F.col("salary_max").cast("double").alias("job_max_salary"),
        F.when(k % 6 == 0, F.lit("")).otherwise(
            F.concat(F.col("first_seen").cast("string"), F.lit("T00:00:00.000Z"))).alias("job_posted_at_datetime_utc"),
        _pick(F.floor(k / 5), ("Full-time and Part-time", "Contract", "", "Internship", "Part-time"))
        .alias("job_employment_type"),
    )
    return j.select("source", "job_id", F.col("last_seen").alias("fetched_at"),
                    F.to_json(rec, {"ignoreNullFields": "false"}).alias("payload"))


def sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E: one sighting per event (source adzuna)."""
    e = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value", "props")
    return e.select(
        F.lit("adzuna").alias("source"),
        F.col("user_id").cast("string").alias("job_id"),
        F.col("ts").cast("date").alias("run_date"),
        F.col("ts"),
        F.col("event_id"),
        F.col("props").alias("payload"),
        F.col("event_type").alias("city"),
        F.concat(F.lit("r"), (F.col("user_id") % 3).cast("string")).alias("role"),
        F.col("value"),
    )


def posting_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per job and day it was sighted (E), with attributes that change from day to day:
    city, role and salary are those of the day's first event, title and text go by the job's key."""
    e = sightings(spark, sf_dir)
    day = e.groupBy("source", "job_id", "run_date").agg(F.min_by(F.struct("city", "role", "value", "event_id"), F.struct("ts", "event_id")).alias("f"))
    first = e.groupBy("source", "job_id").agg(F.min("run_date").alias("first_seen"))
    k = F.col("job_id").cast("bigint")
    salary = F.when(F.col("f.event_id") % 7 != 0, F.col("f.value").cast("decimal(12,2)"))
    title, text = _pick(k, TITLES), _pick(k, DESCRIPTIONS)
    return day.join(first, ["source", "job_id"]).select(
        "source", "job_id", F.col("f.city").alias("city"), F.col("f.role").alias("state_code"), "first_seen", F.col("run_date").alias("last_seen"),
        salary.alias("salary_min"), (salary * 2).cast("decimal(12,2)").alias("salary_max"),
        T.title_seniority(title).alias("seniority"), T.is_remote(title, text).alias("is_remote"), T.job_type_observed(text).alias("job_type"))


def landed_second_pages(postings_df: DataFrame, run_date: str = K.FIXTURE_RUN_DATE) -> DataFrame:
    """Second-source response pages ``{data: [...]}``: one per city and key range."""
    j = postings_df.where((F.col("source") == "jsearch") & (F.col("last_seen") == F.lit(run_date).cast("date")))
    k = F.col("job_id").cast("bigint")
    j = j.select("city", F.concat(F.lit("r"), F.floor(k / PULL_KEYS_PER_ROLE).cast("string")).alias("role"),
                 (F.floor(k / KEYS_PER_PAGE) % PAGES_PER_PULL + 1).cast("int").alias("page"),
                 F.struct("job_id", F.col("title").alias("job_title")).alias("rec"))
    return j.groupBy("city", "role", "page").agg(F.array_sort(F.collect_list("rec")).alias("data")).select(
        F.lit(run_date).cast("date").alias("run_date"), "city", "role", "page", F.to_json(F.struct("data")).alias("body"))


def housing_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H: one wide housing row per nation with a YYYY-MM-DD column per month."""
    li = table(spark, sf_dir, "lineitem", "l_suppkey", "l_extendedprice", "l_shipdate")
    s = table(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
    # Pre-aggregate per supplier nation and month before touching the nation table.
    month = F.date_format(F.last_day("l_shipdate"), "yyyy-MM-dd")
    months = [r[0] for r in li.select(month.alias("m")).where("m is not null").distinct().orderBy("m").collect()]  # one a month
    per_nation = (li.withColumn("_m", month).join(s, li.l_suppkey == s.s_suppkey)
                  .groupBy("s_nationkey").pivot("_m", months).agg(F.round(F.avg("l_extendedprice") / 30, 2)))
    n = _nations(spark, sf_dir)
    return (n.join(per_nation, n.n_nationkey == per_nation.s_nationkey, "left")
            .select((F.col("n_nationkey") + 1).alias("RegionID"),
                    F.col("n_nationkey").alias("SizeRank"),
                    F.lower("n_name").alias("RegionName"),
                    F.when(F.col("n_nationkey") % 6 == 5, "country").otherwise("msa").alias("RegionType"),
                    F.col("r_name").alias("StateName"),
                    *[F.col(f"`{m}`") for m in months]))


def pull_runs(sightings_df: DataFrame) -> DataFrame:
    """Two runs a day: sightings before noon belong to run 0, the rest to run 1."""
    return sightings_df.withColumn("run", F.when(F.hour("ts") < 12, 0).otherwise(1))


def page_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A one-row-per-page pull log (the pre-consolidation audit shape)."""
    e = sightings(spark, sf_dir)
    return e.select("run_date", "city", "role", F.col("job_id").cast("bigint").alias("api_count"),
                    F.col("value").alias("api_mean_salary"), F.col("ts").alias("pulled_at"),
                    F.floor("value").cast("int").alias("jobs_retrieved"), "event_id")


ROLES = ("r0", "r1", "r2")  # role = 'r' || user_id % 3


def raw_jobs_as_of(raw: DataFrame, day: str) -> DataFrame:
    """The bronze table as it stood after ``day``'s run (rows first seen later removed,
    a sighting after ``day`` undone)."""
    d = F.lit(day).cast("date")
    later = F.col("last_seen") > d
    return (raw.where(F.col("first_seen") <= d)
            .withColumn("times_seen", F.when(later, F.col("times_seen") - 1).otherwise(F.col("times_seen")))
            .withColumn("last_seen", F.when(later, d).otherwise(F.col("last_seen"))))


def cbsa_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A city -> CBSA code lookup keyed by padded, mixed-case names (one region left out)."""
    n = table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region", "r_regionkey", "r_name")
    return (n.join(r, n.n_regionkey == r.r_regionkey).where(F.col("r_name") != "MIDDLE EAST")
            .select(F.lower("r_name").alias("state_code"),
                    F.concat(F.lit(" "), F.col("n_name"), F.lit(" ")).alias("primary_city"),
                    F.lpad((F.col("n_nationkey") * 37 + 10000).cast("string"), 5, "0").alias("cbsa_code")))


# Landed pages: a pull = (run_date, city, role bucket); keys are bucketed so every page
# holds records from a fixed key range (bounded size at any scale).
PULL_KEYS_PER_ROLE = 30000
KEYS_PER_PAGE = 500
PAGES_PER_PULL = 24
CORRUPT_PAGE, EMPTY_PAGE = 9, 5


def landed_pages(postings_df: DataFrame, run_date: str = K.FIXTURE_RUN_DATE) -> DataFrame:
    """Page envelopes for the postings seen on ``run_date``: one row per (pull, page).

    Some pulls get an unparsable page 9 or an empty page 5; pages past the
    page limit are landed too, so the prefix rule and the limit both apply.
    """
    j = postings_df.where((F.col("source") == "adzuna") & (F.col("last_seen") == F.lit(run_date).cast("date")))
    k = F.col("job_id").cast("bigint")
    bucket = F.floor(k / PULL_KEYS_PER_ROLE)
    j = j.select("*", F.lit(run_date).cast("date").alias("run_date"),
                 F.concat(F.lit("r"), bucket.cast("string")).alias("role"),
                 (F.floor(k / KEYS_PER_PAGE) % PAGES_PER_PULL + 1).cast("int").alias("page"),
                 ((bucket + F.ascii(F.substring("city", -1, 1))) % 3).cast("int").alias("_defect"))
    rec = _payload_struct(j, F.lit(-1))
    pull = ["run_date", "city", "role"]
    meta = j.groupBy(*pull).agg(F.count("*").alias("count"), F.max(F.col("salary_max").cast("double")).alias("mean"))
    pages = j.groupBy(*pull, "page", "_defect").agg(F.array_sort(F.collect_list(rec)).alias("results"))
    pages = pages.join(meta, pull)
    empty = (F.col("_defect") == 1) & (F.col("page") == EMPTY_PAGE)
    corrupt = (F.col("_defect") == 0) & (F.col("page") == CORRUPT_PAGE)
    body = F.to_json(F.struct("count", "mean", F.when(empty, F.array().cast(pages.schema["results"].dataType))
                              .otherwise(F.col("results")).alias("results")))
    return pages.select(*pull, "page", F.when(corrupt, F.substring(body, 1, 30)).otherwise(body).alias("body"))
