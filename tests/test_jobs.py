"""End to end: landed pages for three run dates -> streaming ingest -> enrich -> gold.

Re-running a day must change nothing; the pull audit must not double count on replay.
"""

import datetime as dt
import os

from pyspark.sql import functions as F

from tests.paths import SF_SMALL
from jobmart.operators import lifecycle as L
from jobmart.plans import jobs, registry
from jobmart.sources import adapter, pages
from jobmart.streaming.ingest import start_page_ingest

DAYS = ["2001-07-30", "2001-07-31", "2001-08-01"]


def _landing_for(spark, day):
    """Postings seen on ``day`` landed as page envelopes (the adapter's page layout)."""
    j = registry.postings(spark, SF_SMALL).withColumn("last_seen", F.lit(day).cast("date"))
    j = j.where(F.col("first_seen") <= F.lit(day).cast("date"))
    return adapter.landed_pages(j, day)


def test_stream_ingest_enrich_gold(spark, tmp_root):
    landing, root = os.path.join(tmp_root, "landing"), os.path.join(tmp_root, "store")
    ckpt = os.path.join(tmp_root, "ckpt")
    for day in DAYS:
        _landing_for(spark, day).write.json(os.path.join(landing, f"day={day}"))
    q = start_page_ingest(spark, os.path.join(landing, "*"), root, ckpt)
    q.awaitTermination(300)
    bronze = jobs.bronze_current(spark, root)
    # Same result as folding the landed records as one multi-day batch.
    recs = pages.page_records(pages.read_landed(spark, os.path.join(landing, "*")))
    batch = recs.select("source", "job_id", "run_date", "payload", *jobs.PULL_ORDER)
    exp = L.upsert_sightings(L.empty_target(spark), batch, jobs.PULL_ORDER).drop("changed")
    assert sorted(map(tuple, bronze.collect())) == sorted(map(tuple, exp.collect()))
    calls = jobs.job_calls(spark, root)
    total_new = calls.agg(F.sum("jobs_retrieved")).first()[0]
    assert total_new == bronze.agg(F.sum("times_seen")).first()[0]

    # A later re-pull of the last day (a new batch) finds nothing new and adds no audit counts.
    (stream, last_batch), = jobs.bronze_log(spark, root).ends().items()
    last = pages.read_landed(spark, os.path.join(landing, f"day={DAYS[-1]}"))
    out = jobs.ingest_pages(spark, last, root, last_batch + 1, stream)
    assert out["n_new"] == 0
    assert jobs.job_calls(spark, root).agg(F.sum("jobs_retrieved")).first()[0] == total_new
    # Replaying the stream's own last batch (same id, same files) is idempotent.
    if last_batch == 0:
        jobs.ingest_pages(spark, pages.read_landed(spark, os.path.join(landing, "*")), root, 0, stream)
        assert jobs.job_calls(spark, root).agg(F.sum("jobs_retrieved")).first()[0] == total_new
        assert sorted(map(tuple, jobs.bronze_current(spark, root).collect())) == sorted(map(tuple, bronze.collect()))

    # Compaction folds the log into a snapshot without changing what readers see.
    jobs.compact_bronze(spark, root)
    assert sorted(map(tuple, jobs.bronze_current(spark, root).collect())) == sorted(map(tuple, bronze.collect()))

    # Enrichment twice on the same day: identical silver.
    s1 = jobs.enrich(spark, root, DAYS[-1])["silver"]
    rows1 = sorted(map(tuple, s1.collect()))
    # The key-restricted daily job equals a from-scratch enrichment of current bronze.
    from jobmart.operators import silver as S

    full, _ = S.split_valid(S.enrich_first_source(jobs.bronze_current(spark, root), DAYS[-1]))
    cols = [c for c in jobs.SILVER_COLS if c not in ("processed_at", "updated_at")] + ["is_active"]
    assert sorted(map(tuple, s1.select(*cols).collect())) == sorted(map(tuple, full.select(*cols).collect()))
    s2 = jobs.enrich(spark, root, DAYS[-1])["silver"]
    assert sorted(map(tuple, s2.collect())) == rows1
    jobs.compact_silver(spark, root)
    assert sorted(map(tuple, jobs.silver_current(spark, root, DAYS[-1]).collect())) == rows1

    # A posting seen again on a later day is re-enriched: processed_at stays, updated_at moves.
    one = s1.select("source", "job_id", "processed_at", "updated_at").where("source = 'adzuna'") \
        .orderBy("job_id").first()
    later = "2001-08-02"
    more = (registry.postings(spark, SF_SMALL).where(F.col("job_id") == one.job_id)
            .withColumn("last_seen", F.lit(later).cast("date")))
    jobs.ingest_pages(spark, adapter.landed_pages(more, later), root, batch_id=99)
    s3 = jobs.enrich(spark, root, later)["silver"].where(F.col("job_id") == one.job_id).first()
    assert s3.processed_at == one.processed_at and s3.updated_at > one.updated_at
    assert str(s3.last_seen) == later and s3.is_active
    assert s1.where(F.col("is_active") != (F.col("last_seen") == F.lit(DAYS[-1]).cast("date"))).count() == 0

    # SNK-14: a re-enriched posting keeps processed_at and moves updated_at.
    stamps = s1.select("source", "job_id", "processed_at", "updated_at")
    assert stamps.where(F.col("processed_at").isNull() | F.col("updated_at").isNull()).count() == 0

    # Gold: one partition per run date; re-running a date replaces only that date.
    jobs.refresh_gold(spark, root, DAYS[0])
    g = jobs.refresh_gold(spark, root, DAYS[-1])
    g = jobs.refresh_gold(spark, root, DAYS[-1])
    per_date = {str(r.run_date): r.n for r in g["stats"].groupBy("run_date").agg(F.count("*").alias("n")).collect()}
    n_cities = s1.where("source = 'adzuna'").select("city", "state_code").distinct().count()
    assert per_date == {DAYS[0]: n_cities, DAYS[-1]: n_cities}
    assert g["snapshot"].count() == n_cities

    # History backfill over a range keeps other dates. The refresh above ran after one posting had been seen on a
    # later day, so it does not count that one as active; as of the date itself it was active (test_history compares all).
    cols = ["city", "state", "total_jobs", "new_jobs", "median_salary_min"]
    day = lambda df, d: sorted(map(tuple, df.where(F.col("run_date") == d).select(*cols).collect()))
    active = lambda df: df.where(F.col("run_date") == DAYS[-1]).agg(F.sum("active_jobs"), F.sum("expired_jobs")).first()
    before = active(g["stats"])
    expected = day(g["stats"], DAYS[-1])  # read before the backfill replaces those files
    h = jobs.backfill_gold_history(spark, root, DAYS[1], DAYS[-1])
    assert day(h, DAYS[-1]) == expected
    assert tuple(active(h)) == (before[0] + 1, before[1])
    assert sorted(str(r.run_date) for r in h.select("run_date").distinct().collect()) == DAYS


def test_housing_jobs_are_idempotent(spark, tmp_root):
    csv_dir = os.path.join(tmp_root, "csv")
    adapter.housing_wide(spark, SF_SMALL).coalesce(1).write.option("header", True).csv(csv_dir)
    root = os.path.join(tmp_root, "store")
    jobs.ingest_housing(spark, {"zillow_zori": csv_dir}, root)
    h1 = jobs.enrich_housing(spark, root, "zillow_zori", "zillow_zori", "rent_index_latest")
    jobs.ingest_housing(spark, {"zillow_zori": csv_dir}, root)  # loaded twice: no duplicates
    h2 = jobs.enrich_housing(spark, root, "zillow_zori", "zillow_zori", "rent_index_latest")
    assert h2.count() == h1.count() > 0
    months = spark.read.csv(csv_dir, header=True).columns[5:]
    assert h2.select("date_recorded").distinct().collect()[0][0] == max(months) and len(months) > 50


def test_backfill_and_v1_batch(spark):
    from jobmart.functions import text as T
    from jobmart.operators import maintenance, silver

    j = registry.postings(spark, SF_SMALL).withColumn("seniority", F.lit("mid")) \
        .withColumn("updated_at", F.lit(None).cast("timestamp"))
    out = maintenance.backfill_seniority(j, T.title_seniority("title"), dry_run=False)
    assert out["table"].where(F.col("seniority") != T.title_seniority("title")).count() == 0
    changed = out["n_changes"].count()
    assert out["table"].where(F.col("updated_at").isNotNull()).count() == changed
    dry = maintenance.backfill_seniority(j, T.title_seniority("title"))
    assert "table" not in dry and dry["sample"].count() == 10

    raw = registry.bronze(spark, SF_SMALL)
    v1 = raw.select("source", "job_id", F.col("last_seen").alias("fetched_at"), "payload")
    empty = spark.createDataFrame([], "source string, job_id string")
    batch = silver.v1_enrichment_batch(v1.where("source = 'adzuna'"), empty, "adzuna", "2001-08-01")
    assert batch.count() == v1.where("source = 'adzuna'").count()


def test_bucketed_bronze_is_not_reshuffled(spark, tmp_root):
    bt = jobs.bronze_snapshot(spark, os.path.join(tmp_root, "store"))
    e = adapter.sightings(spark, SF_SMALL)
    bt.write(L.fold_sightings(e))
    up = L.upsert_sightings(bt.read(), e.where(F.col("run_date") == dt.date(2024, 1, 30)))
    plan = up._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan
    full = [ln for ln in plan.splitlines() if "FullOuter" in ln]
    assert full  # the target side of the full outer join is read in place (no Exchange above its scan)


def test_daily_enrichment_needs_no_shuffle(spark, tmp_root):
    from jobmart.operators import silver as S

    root = os.path.join(tmp_root, "store")
    raw = registry.bronze(spark, SF_SMALL)
    bt, st = jobs.bronze_snapshot(spark, root), jobs.silver_snapshot(spark, root)
    bt.write(raw)
    prev = raw.where("source = 'adzuna' and first_seen <= '2001-07-31'")
    good, _ = S.split_valid(S.enrich_first_source(prev, "2001-07-31"))
    now = F.current_timestamp()
    st.write(good.withColumns({"processed_at": now, "updated_at": now}).select(*jobs.SILVER_COLS))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # the shape it has at scale
    try:
        new, _ = S.enrich_run(bt.read(), st.read(), "2001-08-01")
        plan = new._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Exchange hashpartitioning" not in plan and plan.count("Bucketed: true") >= 2


def test_a_days_keys_are_read_from_their_months_only(spark, tmp_root):
    root = os.path.join(tmp_root, "store")
    raw = registry.bronze(spark, SF_SMALL)
    jobs.bronze_snapshot(spark, root).write(raw)
    snap = jobs.bronze_snapshot(spark, root).read()
    assert snap.select("first_month").distinct().count() > 24
    wanted = raw.where("date_format(first_seen, 'yyyy-MM') = '2001-06'").select("source", "job_id")
    some = spark.createDataFrame(wanted.collect())
    cut = jobs.only_months_of(snap, some)
    assert len(cut.inputFiles()) < len(snap.inputFiles()) / 12 and all("first_month=2001-06" in f for f in cut.inputFiles())
    assert sorted(map(tuple, jobs.bronze_current(spark, root, keys=some).collect())) == \
        sorted(map(tuple, raw.join(some, ["source", "job_id"], "left_semi").select(*L.TARGET_COLS).collect()))


def test_cli_daily_flow(spark, tmp_root):
    from jobmart import cli

    landing, root = os.path.join(tmp_root, "landing"), os.path.join(tmp_root, "store")
    _landing_for(spark, DAYS[-1]).write.json(landing)
    cli.main(["--root", root, "ingest-pages", landing])
    cli.main(["--root", root, "enrich", "--run-date", DAYS[-1]])
    cli.main(["--root", root, "gold", "--run-date", DAYS[-1]])
    cli.main(["--root", root, "compact"])
    out = jobs.analyses(spark, root, DAYS[-1])
    assert out["top_cities_active"].count() > 0 and out["remote_share"].count() > 0
    rep = jobs.backfill_descriptions(spark, root).first()
    assert rep.jobs_needing_descriptions >= 0
    assert jobs.backfill_seniority(spark, root)["matrix"].count() >= 1
    dq = {(r.table_name, r.check_name, r.column_name): r.violations for r in jobs.data_quality(spark, root).collect()}
    assert dq[("silver.jobs_v2", "duplicate_key", "source,job_id")] == 0
    assert dq[("gold.city_job_stats", "duplicate_key", "city,state,run_date")] == 0


def test_v1_second_source_ingest_is_insert_only(spark, tmp_root):
    import json

    d = dt.date(2024, 1, 1)
    body = json.dumps({"data": [{"job_id": "a", "job_title": "Analyst"}, {"job_id": "b"}, {"job_id": "a"}]})
    landed = spark.createDataFrame([(d, "Chicago", "r", 1, body)], pages.LANDED_SCHEMA)
    root = os.path.join(tmp_root, "store")
    t1 = jobs.ingest_v1(spark, landed, root, "jsearch", "$.data", 1)
    t2 = jobs.ingest_v1(spark, landed, root, "jsearch", "$.data", 1)
    assert sorted((r.job_id, str(r.fetched_at)) for r in t2.collect()) == [("a", "2024-01-01"), ("b", "2024-01-01")]
    assert t1.count() == t2.count() == 2


def test_batches_with_compaction_equal_the_fold(spark, tmp_root):
    root = os.path.join(tmp_root, "store")
    landed_days = []
    for b, day in enumerate(DAYS):
        d = os.path.join(tmp_root, f"land{b}")
        _landing_for(spark, day).write.json(d)
        landed_days.append(pages.read_landed(spark, d))
        jobs.ingest_pages(spark, landed_days[-1], root, batch_id=b)
        if b == 1:
            jobs.compact_bronze(spark, root)  # snapshot covers batches 0-1, batch 2 stays in the log
    recs = landed_days[0].unionByName(landed_days[1]).unionByName(landed_days[2])
    batch = pages.page_records(recs).select("source", "job_id", "run_date", "payload", *jobs.PULL_ORDER)
    exp = L.upsert_sightings(L.empty_target(spark), batch, jobs.PULL_ORDER).drop("changed")
    got = jobs.bronze_current(spark, root)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exp.collect()))
    audited = jobs.job_calls(spark, root).agg(F.sum("jobs_retrieved")).first()[0]
    assert audited == got.agg(F.sum("times_seen")).first()[0]


def test_stream_in_several_micro_batches(spark, tmp_root):
    """One landed file per day, one file per micro-batch: same bronze and audit as the plain fold."""
    landing, root = os.path.join(tmp_root, "landing"), os.path.join(tmp_root, "store")
    for day in DAYS:
        _landing_for(spark, day).coalesce(1).write.json(os.path.join(landing, f"day={day}"))
    q = start_page_ingest(spark, os.path.join(landing, "*"), root, os.path.join(tmp_root, "ckpt"),
                          max_files_per_trigger=1)
    q.awaitTermination(600)
    assert list(jobs.bronze_log(spark, root).ends().values()) == [len(DAYS) - 1]  # three micro-batches
    recs = pages.page_records(pages.read_landed(spark, os.path.join(landing, "*")))
    batch = recs.select("source", "job_id", "run_date", "payload", *jobs.PULL_ORDER)
    exp = L.upsert_sightings(L.empty_target(spark), batch, jobs.PULL_ORDER).drop("changed")
    got = jobs.bronze_current(spark, root)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exp.collect()))
    assert jobs.job_calls(spark, root).agg(F.sum("jobs_retrieved")).first()[0] == \
        got.agg(F.sum("times_seen")).first()[0]
    # Restarting on the same checkpoint (e.g. after a lost driver) finds nothing new.
    before = sorted(map(tuple, got.collect()))
    start_page_ingest(spark, os.path.join(landing, "*"), root, os.path.join(tmp_root, "ckpt"),
                      max_files_per_trigger=1).awaitTermination(300)
    assert list(jobs.bronze_log(spark, root).ends().values()) == [len(DAYS) - 1]
    assert sorted(map(tuple, jobs.bronze_current(spark, root).collect())) == before


def test_stream_raw_response_files(spark, tmp_root):
    import json

    landing, root = os.path.join(tmp_root, "landing"), os.path.join(tmp_root, "store")
    body = {"count": 2, "mean": 1.0, "results": [{"id": "a", "title": "Senior Analyst"}, {"id": "b", "title": "x"}]}
    d = os.path.join(landing, "run_date=2024-01-02", "city=Chicago", "role=data analyst", "page=1")
    os.makedirs(d)
    with open(os.path.join(d, "response.json"), "w") as f:
        json.dump(body, f, indent=2)
    q = start_page_ingest(spark, landing, root, os.path.join(tmp_root, "ckpt"), layout="files")
    q.awaitTermination(300)
    got = sorted((r.job_id, str(r.first_seen), r.times_seen) for r in jobs.bronze_current(spark, root).collect())
    assert got == [("a", "2024-01-02", 1), ("b", "2024-01-02", 1)]
    assert jobs.job_calls(spark, root).first().jobs_retrieved == 2


def test_enrich_rerun_after_crash_before_marker(spark, tmp_root):
    """A crash after the silver log write but before the marker moves: the rerun repeats the
    work and current silver is unchanged (duplicates in the log collapse on read)."""
    root = os.path.join(tmp_root, "store")
    d = os.path.join(tmp_root, "land")
    _landing_for(spark, DAYS[-1]).write.json(d)
    jobs.ingest_pages(spark, pages.read_landed(spark, d), root, batch_id=0)
    marker = jobs._enriched_marker(spark, root)
    before_meta = marker.meta()
    cols = [c for c in jobs.SILVER_COLS if c not in ("processed_at", "updated_at")] + ["is_active"]
    s1 = sorted(map(tuple, jobs.enrich(spark, root, DAYS[-1])["silver"].select(*cols).collect()))
    marker.write(spark.createDataFrame([], "batch_id bigint"), meta=before_meta)  # roll the marker back
    s2 = sorted(map(tuple, jobs.enrich(spark, root, DAYS[-1])["silver"].select(*cols).collect()))
    assert s1 == s2 and len(s1) > 0


def _pull(tmp_root, name, jobs_seen, day="2024-01-02", city="Chicago"):
    """One landed page file (JSON lines) of the page log."""
    import json

    path = os.path.join(tmp_root, name)
    os.makedirs(path)
    body = json.dumps({"count": len(jobs_seen), "mean": 1.0, "results": [{"id": j, "title": "x"} for j in jobs_seen]})
    with open(os.path.join(path, "page.json"), "w") as f:
        f.write(json.dumps({"run_date": day, "city": city, "role": "r", "page": 1, "body": body}) + "\n")
    return path


def _sightings(spark, root):
    return sorted((r.job_id, str(r.first_seen), str(r.last_seen), r.times_seen) for r in jobs.bronze_current(spark, root).collect())


def test_two_checkpoints_on_one_root_lose_nothing(spark, tmp_root):
    """Both streams number their batches from 0; neither overwrites the other's rows, before or after a compaction."""
    root = os.path.join(tmp_root, "store")
    first = _pull(tmp_root, "land1", ["1", "2"])
    second = _pull(tmp_root, "land2", ["3"], city="Detroit")
    start_page_ingest(spark, first, root, os.path.join(tmp_root, "c1")).awaitTermination(300)
    jobs.compact_bronze(spark, root)  # the second stream's batch 0 comes after a watermark with a batch 0
    start_page_ingest(spark, second, root, os.path.join(tmp_root, "c2")).awaitTermination(300)
    day = "2024-01-02"
    assert _sightings(spark, root) == [(j, day, day, 1) for j in "123"]
    assert sorted(jobs.bronze_log(spark, root).ends().values()) == [0, 0]
    assert jobs.job_calls(spark, root).agg(F.sum("jobs_retrieved")).first()[0] == 3
    jobs.compact_bronze(spark, root)
    assert _sightings(spark, root) == [(j, day, day, 1) for j in "123"]
    # An enrichment covers both streams.
    assert sorted(r.job_id for r in jobs.enrich(spark, root, day)["silver"].collect()) == ["1", "2", "3"]


def test_deleted_checkpoint_loses_and_repeats_nothing(spark, tmp_root):
    """A new checkpoint reads all pages again: same bronze, same audit, and later pages still come in."""
    root, landing = os.path.join(tmp_root, "store"), os.path.join(tmp_root, "all")
    _pull(landing, "d1", ["1", "2"])
    _pull(landing, "d2", ["2", "3"], day="2024-01-03")
    start_page_ingest(spark, os.path.join(landing, "*"), root, os.path.join(tmp_root, "c1"), max_files_per_trigger=1).awaitTermination(300)
    before, audit = _sightings(spark, root), sorted(map(tuple, jobs.job_calls(spark, root).collect()))
    assert before == [("1", "2024-01-02", "2024-01-02", 1), ("2", "2024-01-02", "2024-01-03", 2), ("3", "2024-01-03", "2024-01-03", 1)]
    jobs.compact_bronze(spark, root)
    start_page_ingest(spark, os.path.join(landing, "*"), root, os.path.join(tmp_root, "c2")).awaitTermination(300)
    assert _sightings(spark, root) == before and sorted(map(tuple, jobs.job_calls(spark, root).collect())) == audit
    _pull(landing, "d3", ["4"], day="2024-01-04")
    start_page_ingest(spark, os.path.join(landing, "*"), root, os.path.join(tmp_root, "c2")).awaitTermination(300)
    assert _sightings(spark, root) == [*before, ("4", "2024-01-04", "2024-01-04", 1)]


def _files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_backfills_are_appended_and_keep_concurrent_enrichments(spark, tmp_root, monkeypatch):
    """An enrichment that ends while a backfill runs survives it; earlier files stay as they were."""
    root, day, next_day = os.path.join(tmp_root, "store"), "2024-01-02", "2024-01-03"

    def bring(ids, d, batch, text=None):
        import json

        recs = [{"id": i, "title": "Senior x", **({"description": text} if text else {})} for i in ids]
        landed = spark.createDataFrame([(dt.date.fromisoformat(d), "Chicago", "r", 1, json.dumps({"count": 1, "mean": 1.0, "results": recs}))], pages.LANDED_SCHEMA)
        jobs.ingest_pages(spark, landed, root, batch)
        jobs.enrich(spark, root, d)

    bring(["1", "2"], day, 0)
    # Rows as an older enrichment left them: no description, another grade.
    old = jobs.silver_current(spark, root).withColumn("seniority", F.lit("jr"))
    jobs.silver_log(spark, root).write_batch(old.withColumn("updated_at", F.current_timestamp()).select(*jobs.SILVER_COLS), "older")
    files = _files(root)
    real = jobs._patch

    def slow(spark_, root_, column, values):
        bring(["3", "2"], next_day, 1, "fresh text")  # ends between the backfill's reading and its writing
        real(spark_, root_, column, values)

    monkeypatch.setattr(jobs, "_patch", slow)
    jobs.backfill_seniority(spark, root, dry_run=False)
    monkeypatch.setattr(jobs, "_patch", real)
    got = {r.job_id: r for r in jobs.silver_current(spark, root).collect()}
    assert sorted(got) == ["1", "2", "3"]
    assert got["1"].seniority == "sr" and str(got["2"].last_seen) == next_day and got["2"].description == "fresh text"
    assert got["3"].seniority == "sr"
    assert files.items() <= _files(root).items()
    # Corrections outlive a compaction, and a second backfill finds nothing to do.
    rows = sorted(map(tuple, jobs.silver_current(spark, root).collect()))
    jobs.compact_silver(spark, root)
    assert sorted(map(tuple, jobs.silver_current(spark, root).collect())) == rows
    assert jobs.backfill_seniority(spark, root)["n_changes"].count() == 0


def test_description_corrections_and_their_report(spark, tmp_root):
    import json

    root, day = os.path.join(tmp_root, "store"), "2024-01-02"
    recs = [{"id": "1", "title": "x", "description": "one"}, {"id": "2", "title": "x"}, {"id": "3", "title": "x", "description": "three"}]
    landed = spark.createDataFrame([(dt.date.fromisoformat(day), "Chicago", "r", 1, json.dumps({"count": 3, "mean": 1.0, "results": recs}))], pages.LANDED_SCHEMA)
    jobs.ingest_pages(spark, landed, root, 0)
    jobs.enrich(spark, root, day)
    blank = jobs.silver_current(spark, root).withColumn("description", F.when(F.col("job_id") == "3", F.col("description")))
    jobs.silver_log(spark, root).write_batch(blank.withColumn("updated_at", F.current_timestamp()).select(*jobs.SILVER_COLS), "older")
    before = {r.job_id: r.updated_at for r in jobs.silver_current(spark, root).collect()}
    assert tuple(jobs.backfill_descriptions(spark, root).first()) == (2, 2, 2, 1)
    got = {r.job_id: (r.description, r.updated_at) for r in jobs.silver_current(spark, root).collect()}
    assert {j: d for j, (d, _) in got.items()} == {"1": "one", "2": "", "3": "three"}
    assert got["1"][1] > before["1"] and got["3"][1] == before["3"]
    # Two corrections of one row, of different columns, both hold.
    jobs.backfill_seniority(spark, root, dry_run=False)
    assert jobs.silver_current(spark, root).where("job_id = '1'").first().description == "one"


def test_city_tables_call_import_and_suffixed_metros(spark, tmp_root):
    from jobmart import cli

    landing, root, csv = (os.path.join(tmp_root, x) for x in ("landing", "store", "csv"))
    _landing_for(spark, DAYS[-1]).write.json(landing)
    cli.main(["--root", root, "ingest-pages", landing])
    cli.main(["--root", root, "enrich", "--run-date", DAYS[-1]])
    wide = adapter.housing_wide(spark, SF_SMALL)
    # The landed states are full names without a code, so the rows join on the empty code.
    wide.withColumns({"RegionName": F.concat("RegionName", F.lit(", XX")), "StateName": F.lit("IL")}).write.option("header", True).csv(csv)
    cli.main(["--root", root, "ingest-housing", f"{jobs.RENT_METRIC}={csv}"])
    stored = spark.read.parquet(os.path.join(root, f"bronze_{jobs.RENT_METRIC}"))
    assert {t for _, t in stored.dtypes} == {"string"}  # read once, cast where used
    cli.main(["--root", root, "enrich-housing", jobs.RENT_METRIC])
    plain = jobs.refresh_gold(spark, root, DAYS[-1])["snapshot"].where("zori_latest is not null").count()
    cut = jobs.refresh_gold(spark, root, DAYS[-1], strip_state_suffix=True)["snapshot"].where("zori_latest is not null").count()
    assert plain == 0 < cut
    cli.main(["--root", root, "city-tables", "--run-date", DAYS[-1], "--strip-state-suffix"])
    out = jobs.refresh_city_tables(spark, root, DAYS[-1], strip_state_suffix=True)
    assert out["gold_city_mapping"].where("region_name is not null").count() > 0 and out["gold_posting_trends"].count() > 0
    log = os.path.join(tmp_root, "calls.parquet")
    adapter.page_log(spark, SF_SMALL).write.parquet(log)
    before = jobs.job_calls(spark, root).count()
    for _ in range(2):
        cli.main(["--root", root, "import-calls", "old", log])
    calls = jobs.job_calls(spark, root)
    assert calls.count() == before + adapter.page_log(spark, SF_SMALL).select("run_date", "city", "role").distinct().count()


def test_second_source_rejects_by_type(spark):
    import json

    from jobmart.operators import silver as S

    recs = [{"job_title": "Cook", "job_description": "x"}, {"job_title": 5}, {"job_title": "Cook", "job_description": {"a": 1}}, {"job_title": None}, {"job_title": "Cook", "job_description": None}, {}]
    raw = spark.createDataFrame([("jsearch", str(i), json.dumps(r)) for i, r in enumerate(recs)], "source string, job_id string, payload string")
    got = {r.job_id: r.reject_reason for r in S.enrich_second_source(raw, "2024-01-01").collect()}
    assert got == {"0": None, "1": "bad_title", "2": "bad_description", "3": "null_title", "4": None, "5": None}
