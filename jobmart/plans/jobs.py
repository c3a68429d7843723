"""Job wrappers: the daily ingest, enrichment and gold refresh as writes.

Only these functions write; everything they call is DataFrame -> DataFrame.
All state lives under one root (on a cluster: a shared folder), so each job is
a re-runnable function of (inputs, run_date).

Bronze and silver are *log + snapshot* tables, so a day never rewrites them:

* bronze: every ingest batch appends its page records to ``bronze_log`` (one
  partition per stream and batch, replay = overwrite of that partition only). The
  current lifecycle table is ``upsert_sightings(snapshot, log after watermark)`` — the
  same exact fold the daily upsert performs — evaluated on read, or only for
  the keys a job touches;
* silver: each enrichment or backfill appends the rows it (re)built to ``silver_log``,
  as a stream of its own; current silver is the snapshot upserted with the newest row
  per key, and ``is_active`` is evaluated for the requested run date on read (no daily
  bulk flag rewrite);
* ``compact_bronze`` / ``compact_silver`` fold the log into a new bucketed
  snapshot version now and then (the only full rewrite, amortised).

A watermark names the last batch of every stream, and is always read before the table
it belongs to: what lands in between is read again, never skipped.
"""

from __future__ import annotations

import json
import os
import time
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobmart.operators import calls, gold, lifecycle, silver
from jobmart.sources import pages
from jobmart.sources.store import LogTable, VersionedTable, append_rows, read_rows
from jobmart.sources.tables import write_table

KEY = lifecycle.KEY
# Pulls run one after another: order by when they ran (if landed), then city and role.
PULL_ORDER = ["pulled_at", "city", "role", "page", "position"]
# The log numbers a batch's records in pull order; batches follow each other by when they were first ingested.
LOG_ORDER = ["arrived_at", "arrival"]

BRONZE_SCHEMA = "source string, job_id string, first_seen date, last_seen date, times_seen int, payload string"
BRONZE_LOG_SCHEMA = ("source string, job_id string, run_date date, payload string, pulled_at timestamp, "
                     "city string, role string, page int, position int, arrived_at timestamp, arrival bigint")
CALLS_LOG_SCHEMA = ("run_date date, city string, role string, pages_fetched bigint, api_count bigint, "
                    "api_mean_salary double, jobs_retrieved bigint, arrived_at timestamp")
PAGE_REJECT_SCHEMA = ("run_date date, city string, role string, page int, position int, payload string, "
                      "reject_reason string")
SILVER_ROW_SCHEMA = (
    "source string, job_id string, first_seen date, last_seen date, times_seen int, title string, description string, "
    "company string, location string, cbsa_code string, category string, category_label string, "
    "salary_min decimal(24,6), salary_max decimal(24,6), url string, latitude double, longitude double, city string, "
    "county string, state string, state_code string, post_date date, seniority string, "
    "is_remote boolean, industry string, job_type string, yoe_min int, education string, "
    "processed_at timestamp, updated_at timestamp")
SILVER_COLS = [c.split()[0] for c in SILVER_ROW_SCHEMA.split(", ")]
# The columns that backfills correct.
PATCHED = ["description", "seniority"]
PATCH_SCHEMA = "source string, job_id string, column_name string, value string, base_at timestamp, made_at timestamp"
# What the gold tables read of a silver row (is_active is evaluated for the run date).
GOLD_COLS = ["source", "job_id", "city", "state_code", "first_seen", "last_seen", "salary_min", "salary_max",
             "category_label", "seniority", "is_remote", "job_type"]
SNAPSHOT_SCHEMA = (
    "city string, state string, active_jobs bigint, new_jobs_7d bigint, new_jobs_30d bigint, avg_salary double, "
    "job_growth_rate_7d double, job_growth_rate_30d double, zori_latest double, zori_date date, "
    "salary_to_rent_ratio double, top_categories array<string>")
HOUSING_SCHEMA = ("region_id int, size_rank int, region_name string, state_code string, cbsa_code string, "
                  "data_source string, metric_type string, metric_value_latest double, date_recorded string")
V1_BRONZE_SCHEMA = "job_id string, fetched_at date, source string, payload string"


def _buckets(spark: SparkSession) -> tuple[str, int]:
    # Snapshots are bucketed by job_id while the keys are (source, job_id). job_id alone is
    # high-cardinality, so letting a job_id partitioning serve a (source, job_id) join is
    # skew-free, and it keeps the snapshot side of every daily join in place (a session
    # setting of :func:`jobmart.session.get_spark`; without it the join still is right).
    return "job_id", int(spark.conf.get("jobmart.buckets", "16"))


def _watermark(t: VersionedTable) -> dict[str, int]:
    """The last batch of every stream that the current version covers."""
    return json.loads(t.meta() or "{}")


def _run_name(job: str) -> str:
    """A stream of its own for one run of a job."""
    return f"{job}-{time.time_ns()}-{uuid.uuid4().hex[:8]}"


# --- bronze --------------------------------------------------------------------------------

def bronze_snapshot(spark: SparkSession, root: str) -> VersionedTable:
    """The compacted lifecycle table, bucketed by job_id (``jobmart.buckets``; ~4096 for 100 TB) and partitioned
    by the month a posting was first seen."""
    return VersionedTable(spark, os.path.join(root, "bronze_snapshot"), BRONZE_SCHEMA, bucket_by=_buckets(spark),
                          partition=("first_month", "date_format(first_seen, 'yyyy-MM')"))


def bronze_log(spark: SparkSession, root: str) -> LogTable:
    return LogTable(spark, os.path.join(root, "bronze_log"), BRONZE_LOG_SCHEMA)


def only_months_of(base: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of ``keys``, read from the months those postings were first seen in and from no other.

    The months come from a scan of the keys alone, the small columns of the table; one row a month comes to the
    driver, and the scan of the payloads prunes all other partitions.
    """
    months = base.join(keys, KEY, "left_semi").select("first_month").distinct().collect()
    return base.where(F.col("first_month").isin([r[0] for r in months])).join(keys, KEY, "left_semi")


def bronze_current(spark: SparkSession, root: str, keys: DataFrame | None = None,
                   exclude: tuple[str, int] | None = None) -> DataFrame:
    """bronze.raw_jobs as of now: snapshot + the log after its watermark, folded exactly.

    ``keys`` restricts the work to some job keys (semi-joins on both sides), which is
    how a daily job reads the state of just the postings it touches.
    """
    snap = bronze_snapshot(spark, root)
    seen = _watermark(snap)  # before the version: one that is committed meanwhile only repeats log rows
    base, log = snap.read(), bronze_log(spark, root).read(after=seen, exclude=exclude)
    if keys is not None:
        base, log = only_months_of(base, keys), log.join(keys, KEY, "left_semi")
    return lifecycle.upsert_sightings(base, log, LOG_ORDER).drop("changed")


def compact_bronze(spark: SparkSession, root: str) -> DataFrame | None:
    """Fold the log into a new snapshot version (the watermark moves to the streams' last batches)."""
    ends = bronze_log(spark, root).ends()
    if not ends:
        return None
    return bronze_snapshot(spark, root).write(bronze_current(spark, root), meta=json.dumps(ends))


def calls_log_table(spark: SparkSession, root: str) -> LogTable:
    return LogTable(spark, os.path.join(root, "bronze_job_calls_log"), CALLS_LOG_SCHEMA)


def page_rejects(spark: SparkSession, root: str) -> LogTable:
    return LogTable(spark, os.path.join(root, "bronze_page_rejects"), PAGE_REJECT_SCHEMA)


def credited_pulls(batch: DataFrame, target: DataFrame) -> DataFrame:
    """New sightings per pull: for every (job, day) newer than the table, the first pull
    (in pull order) that saw it — exactly the rows the day-by-day upsert reports as changed."""
    t_last = target.select(*KEY, F.col("last_seen").alias("_t_last"))
    days = (batch.join(t_last, KEY, "left")
            .where(F.col("_t_last").isNull() | (F.col("run_date") > F.col("_t_last"))))
    first = days.groupBy(*KEY, "run_date").agg(F.min(F.struct(*PULL_ORDER)).alias("_p"))
    return (first.groupBy("run_date", F.col("_p.city").alias("city"), F.col("_p.role").alias("role"))
            .agg(F.count("*").alias("jobs_retrieved")))


def _numbered(batch: DataFrame) -> DataFrame:
    """``arrival``: the position of a record in its batch, in pull order."""
    return (batch.repartitionByRange(*PULL_ORDER).sortWithinPartitions(*PULL_ORDER, "payload")
            .withColumn("arrival", F.monotonically_increasing_id()))


def ingest_pages(spark: SparkSession, landed: DataFrame, root: str, batch_id: int, stream: str = "manual") -> dict:
    """PIP-1: landed pages -> bronze sightings log (SNK-4) + pull audit (SNK-6).

    A batch is known by its stream and its number there: two streams, or a stream that starts
    over under a new name, never write the same partition. Every good landed page is kept, in
    whichever batch it comes; records without an id are set aside by name. The writes are the
    batch's own partitions (log, audit, rejects), never a table. Replay-safe: the audit rows of
    the batch (merged with ``greatest``) are written before the log partition; the pre-state
    excludes this batch, and a replay after the log write finds nothing new and keeps the audit.
    """
    log, blog = calls_log_table(spark, root), bronze_log(spark, root)
    mine = (F.col("stream") == stream) & (F.col("batch_id") == batch_id)
    # A replay keeps the time of the first run: batches stay in the order in which they came.
    first_run = blog.read().where(mine).agg(F.min(F.unix_micros("arrived_at"))).first()[0]
    stamp = F.timestamp_micros(F.lit(first_run if first_run is not None else time.time_ns() // 1000))
    # Parsed once: the pre-state, the credits, the summary and the log all read this table.
    every = write_table(pages.page_records(landed), "landed_records")
    recs = every.where(F.col("job_id").isNotNull())
    bad = every.where(F.col("job_id").isNull()).withColumn("reject_reason", F.lit("null_id"))
    page_rejects(spark, root).write_batch(bad.select(*[c.split()[0] for c in PAGE_REJECT_SCHEMA.split(", ")]), stream, batch_id)
    batch = recs.select(*KEY, "run_date", "payload", *PULL_ORDER)
    keys = write_table(batch.select(*KEY).distinct(), "batch_keys")
    target = bronze_current(spark, root, keys=keys, exclude=(stream, batch_id))

    summary = recs.groupBy("run_date", "city", "role").agg(
        F.max("pages_fetched").cast("bigint").alias("pages_fetched"), F.max("api_count").alias("api_count"),
        F.max("api_mean_salary").alias("api_mean_salary"))
    credit = write_table(credited_pulls(batch, target), "pull_credit")
    audit = summary.join(credit, ["run_date", "city", "role"]).where(F.col("jobs_retrieved") > 0)
    key = ["run_date", "city", "role"]
    old = log.read().where(mine).drop("stream", "batch_id", "arrived_at")  # a replay's earlier rows
    merged = (old.join(audit.select(*key, F.col("jobs_retrieved").alias("_new"), *[
        F.col(c).alias(f"_n_{c}") for c in ("pages_fetched", "api_count", "api_mean_salary")]), key, "full")
        .select(*key,
                *[F.coalesce(F.col(f"_n_{c}"), F.col(c)).alias(c) for c in ("pages_fetched", "api_count", "api_mean_salary")],
                F.greatest(F.coalesce("jobs_retrieved", F.lit(0)), F.coalesce("_new", F.lit(0))).alias("jobs_retrieved"),
                stamp.alias("arrived_at")))
    log.write_batch(write_table(merged, "pull_audit"), stream, batch_id)
    blog.write_batch(_numbered(batch).withColumn("arrived_at", stamp), stream, batch_id)
    n_new = credit.agg(F.coalesce(F.sum("jobs_retrieved"), F.lit(0))).first()[0]
    return {"n_new": n_new}


def job_calls(spark: SparkSession, root: str) -> DataFrame:
    """bronze.job_calls as read: one row per pull, jobs_retrieved summed over batches.

    A pull may come in several batches: the last page of any of them counts, and the
    page-1 values are those of the newest batch that has page 1.
    """
    log = calls_log_table(spark, root).read()
    newest = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("arrived_at"))).alias(c)
    return log.groupBy(*calls.CALL_KEY).agg(
        F.max("pages_fetched").alias("pages_fetched"), newest("api_count"), newest("api_mean_salary"),
        F.sum("jobs_retrieved").alias("jobs_retrieved"))


# --- silver --------------------------------------------------------------------------------

def silver_snapshot(spark: SparkSession, root: str) -> VersionedTable:
    return VersionedTable(spark, os.path.join(root, "silver_snapshot"), SILVER_ROW_SCHEMA, bucket_by=_buckets(spark))


def silver_log(spark: SparkSession, root: str) -> LogTable:
    return LogTable(spark, os.path.join(root, "silver_log"), SILVER_ROW_SCHEMA)


def silver_patches(spark: SparkSession, root: str) -> LogTable:
    """Corrections of single columns; ``base_at`` is the ``updated_at`` of the row that a correction was made from."""
    return LogTable(spark, os.path.join(root, "silver_patches"), PATCH_SCHEMA)


def _newest_rows(log: DataFrame) -> DataFrame:
    """The newest logged row per key (by last_seen, then updated_at), with the first time the key was processed."""
    log = log.withColumns({"_seen": F.col("last_seen").cast("timestamp"), "_at": F.unix_micros("updated_at")})
    rows = log.select(*SILVER_COLS, lifecycle.arrival(log, ["_seen", "_at"]).alias("_a"))
    winners = rows.groupBy(*KEY).agg(F.min("processed_at").alias("_first"), F.max("_a").alias("_a"))
    return (lifecycle.fetch(rows, winners, [*KEY, "_a"]).withColumn("processed_at", F.col("_first"))
            .select(*SILVER_COLS))


def _patched(rows: DataFrame, patches: DataFrame) -> DataFrame:
    """Each column's newest correction, unless the row was enriched again after the one that it was made from."""
    each = [*KEY, "column_name"]
    newest = lifecycle.last_per_key(patches, each, ["made_at"], ["value", "base_at", "made_at"])
    out = rows.withColumn("_own", F.col("updated_at"))
    for c in PATCHED:
        p = newest.where(F.col("column_name") == c).select(*KEY, F.col("value").alias("_v"), F.col("base_at").alias("_b"), F.col("made_at").alias("_m"))
        # The time a row was enriched decides, not that of another column's correction.
        applies = F.coalesce(F.col("_b") >= F.col("_own"), F.lit(False))
        out = out.join(p, KEY, "left").withColumns({
            c: F.when(applies, F.col("_v")).otherwise(F.col(c)),
            "updated_at": F.greatest("updated_at", F.when(applies, F.col("_m")))}).drop("_v", "_b", "_m")
    return out.select(*rows.columns)


def silver_current(spark: SparkSession, root: str, run_date=None, keys: DataFrame | None = None) -> DataFrame:
    """silver.jobs_v2 as of now: the snapshot upserted with the newest logged row per key, then corrected.

    With ``run_date``, ``is_active`` is evaluated for that date (SNK-11 on read). ``keys`` restricts the
    work to some job keys, below the fold.
    """
    snap = silver_snapshot(spark, root)
    seen = _watermark(snap)
    log, patches = silver_log(spark, root).read(after=seen), silver_patches(spark, root).read(after=seen)
    base = snap.read()
    if keys is not None:
        base, log, patches = (t.join(keys, KEY, "left_semi") for t in (base, log, patches))
    cur = _patched(silver.upsert_silver(base, _newest_rows(log), keep=("processed_at",)), patches)
    return silver.mark_active(cur, run_date) if run_date is not None else cur


def compact_silver(spark: SparkSession, root: str) -> DataFrame:
    """Fold the silver log and the corrections into a new snapshot."""
    ends = {**_watermark(silver_snapshot(spark, root)), **silver_log(spark, root).ends(), **silver_patches(spark, root).ends()}
    return silver_snapshot(spark, root).write(silver_current(spark, root).select(*SILVER_COLS), meta=json.dumps(ends))


def _enriched_marker(spark: SparkSession, root: str) -> VersionedTable:
    """The last bronze batch of every stream that an enrichment has covered (kept as version metadata)."""
    return VersionedTable(spark, os.path.join(root, "silver_enriched_upto"), "batch_id bigint")


def enrich(spark: SparkSession, root: str, run_date) -> dict:
    """PIP-2: bronze -> silver (work set, enrich, quarantine; rows appended to the silver log).

    Only postings that appeared in the bronze log since the last enrichment can be
    new or advanced, so the folds and joins run for those keys alone: of bronze, the months
    those postings were first seen in; of silver, the keys and days. Rejected rows
    are retried when they are seen again (the result is the same: enrichment is
    deterministic).
    """
    marker, blog = _enriched_marker(spark, root), bronze_log(spark, root)
    ends = blog.ends()
    if not ends:
        return {"silver": silver_current(spark, root, run_date)}
    keys = write_table(blog.read(after=_watermark(marker)).select(*KEY).distinct(), "enrich_keys")
    raw = bronze_current(spark, root, keys=keys)
    current = silver_current(spark, root, keys=keys).select(*KEY, "last_seen")
    # The day's work set, parsed and classified once; silver and the rejects both read it.
    enriched = write_table(silver.enrich_first_source(silver.work_set(raw, current), run_date), "enriched_work")
    good, bad = silver.split_valid(enriched)
    run = _run_name("enrich")
    now = F.current_timestamp()  # SNK-14: processed_at kept from the first run (on read), updated_at moves
    silver_log(spark, root).write_batch(good.withColumns({"processed_at": now, "updated_at": now}).select(*SILVER_COLS), run)
    silver_rejects(spark, root).write_batch(bad, run)
    marker.write(spark.createDataFrame([], "batch_id bigint"), meta=json.dumps(ends))  # after the log: a crash re-runs
    return {"silver": silver_current(spark, root, run_date)}


def silver_rejects(spark: SparkSession, root: str, name: str = "silver_rejects") -> LogTable:
    return LogTable(spark, os.path.join(root, name), "source string, job_id string, reject_reason string")


# --- gold ----------------------------------------------------------------------------------

def refresh_gold(spark: SparkSession, root: str, run_date, strip_state_suffix: bool = False) -> dict:
    """PIP-3: city_job_stats partition for run_date (SNK-8) + snapshot upsert (SNK-9), with the rent
    of silver.housing_metrics where it is loaded (JOIN-13). ``strip_state_suffix``: the housing files
    write metros as "Chicago, IL"."""
    # Silver is folded once, with the columns gold reads; all that follows reads this table.
    s = write_table(silver_current(spark, root, run_date).select(*GOLD_COLS, "is_active"), "gold_silver")
    rent = housing_metrics(spark, root).read().where(F.col("metric_type") == RENT_METRIC)
    # All per-city counts of both tables in one scan of silver (small: one row per city).
    counts = write_table(gold.city_aggregates(s, run_date), "gold_city_aggregates")
    stats_path = os.path.join(root, "gold_city_job_stats")
    # Dynamic partition overwrite replaces only this run_date's partition.
    (gold.city_job_stats(s, run_date, counts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_date").parquet(stats_path))
    snap_t = VersionedTable(spark, os.path.join(root, "gold_latest_city_snapshot"), SNAPSHOT_SCHEMA)
    new = gold.latest_city_snapshot(s, run_date, rent, counts=counts, strip_state_suffix=strip_state_suffix)
    old = snap_t.read()
    nk = new.select(F.col("city").alias("_c"), F.col("state").alias("_s"))
    keep = old.join(nk, old.city.eqNullSafe(nk._c) & old.state.eqNullSafe(nk._s), "left_anti")  # vanished cities stay
    snap = snap_t.write(keep.unionByName(new))
    return {"stats": spark.read.parquet(stats_path), "snapshot": snap}


def silver_versions(spark: SparkSession, root: str) -> DataFrame:
    """One row per posting and day it was sighted, with its attributes of that day.

    Sightings are the bronze log's; the attributes are those of the first enrichment on or after the
    sighting (the same day's, where enrichment runs daily). Where a backfill has rewritten the current
    row, it replaces the logged one of the same day. The window holds the days of one posting.
    """
    attrs = [c for c in GOLD_COLS if c not in (*KEY, "last_seen")]
    row = F.struct(*attrs).alias("_r")
    log = silver_log(spark, root).read().select(*KEY, F.col("last_seen").alias("_d"), row, F.lit(0).alias("_p"), "updated_at")
    now = silver_current(spark, root).select(*KEY, F.col("last_seen").alias("_d"), row, F.lit(1).alias("_p"), "updated_at")
    known = log.unionByName(now).groupBy(*KEY, "_d").agg(F.max_by("_r", F.struct("_p", "updated_at")).alias("_r"))
    seen = bronze_log(spark, root).read().select(*KEY, F.col("run_date").alias("_d")).distinct()
    both = (seen.withColumns({"_kind": F.lit(0), "_r": F.lit(None).cast(known.schema["_r"].dataType)})
            .unionByName(known.withColumn("_kind", F.lit(1))))
    w = Window.partitionBy(*KEY).orderBy("_d", "_kind").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return (both.withColumn("_r", F.first("_r", ignorenulls=True).over(w)).where("_kind = 0 and _r is not null")
            .select(*KEY, F.col("_d").alias("last_seen"), "_r.*"))


def backfill_gold_history(spark: SparkSession, root: str, first_date, last_date) -> DataFrame:
    """city_job_stats for every run date in a range as each day stood, written as run_date
    partitions; dynamic overwrite touches only those dates."""
    stats_path = os.path.join(root, "gold_city_job_stats")
    hist = gold.city_history(silver_versions(spark, root), first_date, last_date, medians=True)
    hist.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_date").parquet(stats_path)
    return spark.read.parquet(stats_path)


# --- housing -------------------------------------------------------------------------------

RENT_METRIC = "rent_index_latest"


def housing_metrics(spark: SparkSession, root: str) -> VersionedTable:
    return VersionedTable(spark, os.path.join(root, "silver_housing_metrics"), HOUSING_SCHEMA)


def ingest_housing(spark: SparkSession, datasets: dict[str, str], root: str) -> dict[str, DataFrame]:
    """SRC-5 / SNK-1: each wide CSV replaces its bronze table (columns taken from the file's header)."""
    from jobmart.operators import housing

    out = {}
    for name, path in datasets.items():
        dest = os.path.join(root, f"bronze_{name}")
        # Texts, as they stand in the file: the columns are cast where they are used, so the file is read once.
        housing.read_wide_csv(spark, path, infer=False).write.mode("overwrite").parquet(dest)
        out[name] = spark.read.parquet(dest)
    return out


def enrich_housing(spark: SparkSession, root: str, name: str, data_source: str, metric_type: str) -> DataFrame:
    """PIP-6: latest metric per metro region into silver.housing_metrics, keyed replace (SNK-2)."""
    from jobmart.operators import housing

    wide = spark.read.parquet(os.path.join(root, f"bronze_{name}"))
    t = housing_metrics(spark, root)
    return t.write(housing.replace_metrics(t.read(), housing.latest_metric(wide, data_source, metric_type)))


def refresh_city_tables(spark: SparkSession, root: str, run_date, strip_state_suffix: bool = False) -> dict[str, DataFrame]:
    """JOIN-6 and AGG-18 as stored tables: the cities' housing regions, and postings per day, city and source."""
    from jobmart.operators import housing, maintenance

    s = silver_current(spark, root, run_date)
    mapping = housing.city_mapping(s, housing_metrics(spark, root).read(), strip_state_suffix)
    tables = {"gold_city_mapping": mapping, "gold_posting_trends": maintenance.posting_trends(s)}
    return {name: VersionedTable(spark, os.path.join(root, name), "city string").write(df) for name, df in tables.items()}


# --- maintenance ---------------------------------------------------------------------------

def import_calls(spark: SparkSession, root: str, log: DataFrame, name: str, per_page: bool = True) -> DataFrame:
    """PIP-9 / PIP-10: an earlier call log into the pull audit, one row per pull.

    ``log``: run_date, city, role, api_count, api_mean_salary, pulled_at, jobs_retrieved; with ``per_page`` a row for
    each page (consolidated, AGG-11), else with pages_fetched and possibly several rows for a pull, of which the
    latest stays (WIN-2). ``name`` is the import's own: importing it again replaces its rows, nothing is counted twice.
    """
    order = ["pulled_at", *[c for c in ("event_id",) if c in log.columns]]
    rows = calls.consolidate(log) if per_page else calls.keep_latest(log, order)
    cols = [c.split()[0] for c in CALLS_LOG_SCHEMA.split(", ")]
    typed = {"api_count": F.col("api_count").cast("bigint"), "api_mean_salary": F.col("api_mean_salary").cast("double"),
             "pages_fetched": F.col("pages_fetched").cast("bigint"), "jobs_retrieved": F.col("jobs_retrieved").cast("bigint"),
             "arrived_at": F.col("pulled_at").cast("timestamp")}
    calls_log_table(spark, root).write_batch(rows.withColumns(typed).select(*cols), f"import-{name}")
    return job_calls(spark, root)


def _patch(spark: SparkSession, root: str, column: str, values: DataFrame) -> None:
    """Appends corrections (KEY, value, base_at); no earlier file is touched."""
    rows = values.select(*KEY, F.lit(column).alias("column_name"), F.col("value").cast("string").alias("value"), "base_at",
                         F.current_timestamp().alias("made_at"))
    silver_patches(spark, root).write_batch(rows, _run_name(f"backfill-{column}"))


def backfill_descriptions(spark: SparkSession, root: str) -> DataFrame:
    """PIP-8 as a job: missing silver descriptions come from bronze, as corrections; returns the report row.

    Bronze is read for the postings without a description only. An enrichment that runs meanwhile loses
    nothing: silver is not rewritten, and a row it renews is newer than the correction.
    """
    from jobmart.operators import maintenance

    own = silver_current(spark, root).where(F.col("source") == "adzuna")
    lacks = maintenance.missing_text("description")
    counts = own.agg(F.count_if(lacks).alias("lacking"), F.count_if(~lacks).alias("having")).first()
    missing = write_table(own.where(lacks).select(*KEY, F.col("updated_at").alias("base_at")), "missing_descriptions")
    found = maintenance.payload_descriptions(bronze_current(spark, root, keys=missing.select(*KEY)))
    values = write_table(missing.join(found, KEY), "description_values")
    _patch(spark, root, "description", values)
    done = values.agg(F.count("*").alias("n"), F.count_if(~maintenance.missing_text("value")).alias("filled")).first()
    return spark.createDataFrame([(counts["lacking"], done["n"], counts["having"] + done["filled"], counts["lacking"] - done["filled"])],
                                 "jobs_needing_descriptions long, updated long, jobs_with_descriptions long, jobs_still_missing long")


def backfill_seniority(spark: SparkSession, root: str, dry_run: bool = True) -> dict:
    """PIP-7 as a job: matrix + sample always; the corrections of the changed rows only when not a dry run."""
    from jobmart.functions import text as T
    from jobmart.operators import maintenance

    cur = silver_current(spark, root)
    out = maintenance.backfill_seniority(cur, T.title_seniority("title"))
    if not dry_run:
        # One reading of silver decides what the report says and what is corrected.
        rows = write_table(cur.select(*KEY, "title", "seniority", "updated_at"), "seniority_rows")
        out = maintenance.backfill_seniority(rows, T.title_seniority("title"))
        changed = out["n_changes"].select(*KEY, F.col("new_seniority").alias("value"))
        _patch(spark, root, "seniority", changed.join(rows.select(*KEY, F.col("updated_at").alias("base_at")), KEY))
        out["table"] = silver_current(spark, root)
    return out


def analyses(spark: SparkSession, root: str, run_date) -> dict[str, DataFrame]:
    """PIP-11 over the stored gold / silver tables."""
    from jobmart.operators import analysis

    stats = spark.read.parquet(os.path.join(root, "gold_city_job_stats"))
    snap = VersionedTable(spark, os.path.join(root, "gold_latest_city_snapshot"), SNAPSHOT_SCHEMA).read()
    s = silver_current(spark, root, run_date)
    return {"top_cities_active": analysis.top_cities_active(snap),
            "city_trend": analysis.city_trend(stats),
            "remote_share": analysis.remote_share(stats, run_date),
            "seniority_distribution": analysis.seniority_distribution(stats, run_date),
            "job_persistence": analysis.job_persistence(s),
            "salary_ranges": analysis.salary_ranges(stats, run_date)}


def data_quality(spark: SparkSession, root: str) -> DataFrame:
    """DQ-1..3 over the stored silver and gold tables (one small long-format report)."""
    from jobmart.operators import maintenance

    s = silver_current(spark, root)
    stats = spark.read.parquet(os.path.join(root, "gold_city_job_stats"))
    return maintenance.dq_report(
        {"silver.jobs_v2": (s, ["source", "job_id"], ["source", "job_id", "title", "first_seen", "last_seen"]),
         "gold.city_job_stats": (stats, ["city", "state", "run_date"],
                                 ["city", "state", "run_date", "total_jobs", "active_jobs", "new_jobs", "expired_jobs"])},
        {"silver.jobs_v2": {"seniority": ["jr", "mid", "sr"]}})


def ingest_v1(spark: SparkSession, landed: DataFrame, root: str, source: str,
              records_path: str = "$.results", max_pages: int | None = None) -> DataFrame:
    """v1 ingest (SRC-3 / PRJ-4 / SNK-3): page records -> bronze.<source>_jobs, insert-ignore
    on (job_id, fetched_at); a replay of the same pages adds nothing."""
    path = os.path.join(root, f"bronze_{source}_jobs")
    old = read_rows(spark, path, V1_BRONZE_SCHEMA)
    recs = pages.page_records(landed, records_path, max_pages, source).where(F.col("job_id").isNotNull())
    rows = pages.to_v1_rows(recs)
    # only the partitions of the batch's days are looked at, only new rows are written
    first = lifecycle.first_per_key(rows, lifecycle.V1_KEY, ["page", "position"], ["source", "payload"])
    days = [r[0] for r in first.select("fetched_at").distinct().collect()]  # run dates of one batch
    new = first.join(old.where(F.col("fetched_at").isin(days)).select(*lifecycle.V1_KEY), lifecycle.V1_KEY, "left_anti")
    append_rows(spark, path, write_table(new.select(*[c.split()[0] for c in V1_BRONZE_SCHEMA.split(", ")]), "v1_new"), "fetched_at")
    return read_rows(spark, path, V1_BRONZE_SCHEMA)


SILVER_V1_SCHEMA = ("source string, job_id string, title string, company string, location string, city string, "
                    "county string, state string, category string, description string, post_date string, url string, "
                    "salary_min double, salary_max double, seniority string, is_remote boolean, job_type string")


def enrich_v1(spark: SparkSession, root: str, source: str, run_date) -> DataFrame:
    """PIP-4 / PIP-5: postings of bronze.<source>_jobs that silver.jobs_v1 lacks, enriched and appended."""
    path = os.path.join(root, "silver_jobs_v1")
    table = read_rows(spark, path, SILVER_V1_SCHEMA)
    bronze = read_rows(spark, os.path.join(root, f"bronze_{source}_jobs"), V1_BRONZE_SCHEMA)
    good, bad = silver.split_valid(write_table(silver.v1_enrichment_batch(bronze, table, source, run_date), "v1_work"))
    silver_rejects(spark, root, "silver_v1_rejects").write_batch(bad, _run_name("enrich_v1"))
    good.select(*table.columns).write.mode("append").partitionBy("source").parquet(path)
    return read_rows(spark, path, SILVER_V1_SCHEMA)
