"""Gold history equals the day-by-day refresh; pages in any split; storage that survives a crash."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tests.paths import SF_SMALL
from jobmart.operators import gold, lifecycle
from jobmart.plans import jobs, registry
from jobmart.sources import adapter, pages
from jobmart.sources.store import VersionedTable

DAYS = ["2001-07-30", "2001-07-31", "2001-08-01"]
COLS = ["city", "state", "run_date", "total_jobs", "active_jobs", "new_jobs", "expired_jobs", "jobs_with_salary", "avg_salary_min",
        "avg_salary_max", "median_salary_min", "median_salary_max", "remote_jobs", "fulltime_jobs", "junior_jobs", "mid_jobs", "senior_jobs"]


def _landing(spark, i, day):
    """A third of the postings each day, so that postings come, go and come back; salaries move."""
    j = registry.postings(spark, SF_SMALL).where((F.col("first_seen") <= day) & (F.col("job_id").cast("bigint") % 4 != i))
    return adapter.landed_pages(j.withColumns({"last_seen": F.lit(day).cast("date"), "salary_max": (F.col("salary_max") + 10 * i).cast("decimal(12,2)")}), day)


def test_backfill_equals_daily_refresh_on_every_date(spark, tmp_root):
    root, daily = os.path.join(tmp_root, "store"), []
    csv = os.path.join(tmp_root, "csv")
    adapter.housing_wide(spark, SF_SMALL).withColumn("StateName", F.lit("IL")).write.option("header", True).csv(csv)
    jobs.ingest_housing(spark, {"zillow_zori": csv}, root)
    jobs.enrich_housing(spark, root, "zillow_zori", "zillow_zori", jobs.RENT_METRIC)
    for i, day in enumerate(DAYS):
        jobs.ingest_pages(spark, _landing(spark, i, day), root, batch_id=i)
        jobs.enrich(spark, root, day)
        out = jobs.refresh_gold(spark, root, day)
        daily += out["stats"].where(F.col("run_date") == day).select(*COLS).collect()
    want = sorted(map(str, daily))
    h = jobs.backfill_gold_history(spark, root, DAYS[0], DAYS[-1])
    assert sorted(map(str, h.select(*COLS).collect())) == want and len({r.active_jobs for r in daily}) > 3
    # rent is in the stored snapshot
    snap = out["snapshot"].where("zori_latest is not null").collect()
    assert snap and all(r.zori_date is not None and r.salary_to_rent_ratio == pytest.approx(r.avg_salary / r.zori_latest) for r in snap if r.avg_salary)


def test_history_of_one_posting(spark):
    rows = [("adzuna", "a", d, "2001-07-01", "X", 1.0) for d in ("2001-07-01", "2001-07-02", "2001-07-03")] + [("adzuna", "b", "2001-07-03", "2001-07-03", "X", None)]
    v = spark.createDataFrame(rows, "source string, job_id string, last_seen string, first_seen string, city string, s double").select(
        "source", "job_id", F.col("last_seen").cast("date").alias("last_seen"), F.col("first_seen").cast("date").alias("first_seen"), "city", F.lit("S").alias("state_code"),
        F.col("s").cast("decimal(12,2)").alias("salary_min"), F.lit(None).cast("decimal(12,2)").alias("salary_max"),
        F.lit("mid").alias("seniority"), F.lit(False).alias("is_remote"), F.lit(None).cast("string").alias("job_type"))
    got = {str(r.run_date): (r.total_jobs, r.active_jobs, r.new_jobs, r.expired_jobs, r.avg_salary_min) for r in gold.city_history(v, "2001-07-01", "2001-07-04").collect()}
    assert got == {"2001-07-01": (1, 1, 1, 0, 1.0), "2001-07-02": (1, 1, 0, 0, 1.0), "2001-07-03": (2, 2, 1, 0, 1.0), "2001-07-04": (2, 0, 0, 2, 1.0)}


def test_no_page_is_lost_in_any_split(spark, tmp_root):
    r = random.Random(5)
    rows = [("2001-08-01", c, "r", p, '{"count": 40, "mean": 2.0, "results": [{"id": "%s%d", "title": "t"}]}' % (c, p)) for c in "AB" for p in range(1, 26)]
    rows += [("2001-08-01", "A", "r", 26, '{"results": [{"title": "no id"}]}'), ("2001-08-01", "A", "r", 27, "broken")]
    df = spark.createDataFrame(rows, "d string, city string, role string, page int, body string").select(F.col("d").cast("date").alias("run_date"), "city", "role", "page", "body")
    whole = os.path.join(tmp_root, "whole")
    jobs.ingest_pages(spark, df, whole, batch_id=0)
    split = os.path.join(tmp_root, "split")
    part = {(c, p): r.randint(0, 2) for c in "AB" for p in range(1, 28)}
    key = F.create_map(*[F.lit(x) for (c, p), n in part.items() for x in (f"{c}{p}", n)])
    for n in range(3):
        jobs.ingest_pages(spark, df.where(key[F.concat("city", F.col("page").cast("string"))] == n), split, batch_id=n)
    a, b = (sorted(map(str, jobs.bronze_current(spark, x).collect())) for x in (whole, split))
    assert a == b and len(a) == 50
    c, d = (sorted(map(str, jobs.job_calls(spark, x).collect())) for x in (whole, split))
    assert c == d and all("jobs_retrieved=25" in x for x in c)
    assert [x.reject_reason for x in jobs.page_rejects(spark, split).read().collect()] == ["null_id"]


def test_a_batch_leaves_earlier_partitions_alone(spark, tmp_root):
    files = lambda: {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(tmp_root) for f in fs if f.endswith(".parquet")}
    jobs.ingest_pages(spark, _landing(spark, 0, DAYS[0]), tmp_root, batch_id=0)
    v1 = jobs.ingest_v1(spark, _landing(spark, 0, DAYS[0]), tmp_root, "adzuna").count()
    before = files()
    jobs.ingest_pages(spark, _landing(spark, 1, DAYS[1]), tmp_root, batch_id=1)
    assert jobs.ingest_v1(spark, _landing(spark, 1, DAYS[1]), tmp_root, "adzuna").count() > v1
    n = jobs.ingest_v1(spark, _landing(spark, 1, DAYS[1]), tmp_root, "adzuna").count()  # replay
    assert before.items() <= files().items()
    good = jobs.enrich_v1(spark, tmp_root, "adzuna", DAYS[1]).count()
    assert 0 < good < n and jobs.enrich_v1(spark, tmp_root, "adzuna", DAYS[1]).count() == good


def test_store_survives_a_stop_between_steps(spark, tmp_root):
    t = VersionedTable(spark, os.path.join(tmp_root, "t"), "a int")
    assert t.read().count() == 0
    t.write(spark.range(3).select(F.col("id").cast("int").alias("a")), meta="m1")
    t.stage(spark.range(9).select(F.col("id").cast("int").alias("a")))  # written, never committed
    assert t.read().count() == 3 and t.meta() == "m1"
    t.write(t.read().where("a > 0"))
    assert t.read().count() == 2 and t.meta() == ""


def test_plain_counts_write_nothing_while_planned(spark, monkeypatch):
    from jobmart.operators import quantiles

    monkeypatch.setattr(quantiles, "write_table", lambda *a, **k: pytest.fail("a median ran"))
    for name in ("remote_share", "seniority_distribution", "city_score_inputs", "dq_report", "city_trend"):
        registry.queries()[name](spark, SF_SMALL)


def test_running_medians_equal_each_days_median(spark, monkeypatch):
    """Members that come and go, a hot and a null group, equal values and a wide spread, against plain sorting."""
    import datetime as dt

    from jobmart.operators import quantiles

    monkeypatch.setattr(quantiles, "DAY_SLOTS", 32)  # several levels
    r, d0, days = random.Random(3), dt.date(2024, 1, 1), 12
    rows = []
    for _ in range(600):
        start = r.randint(-4, days + 2)
        rows.append((r.choice(["x", None, "hot", "hot", "hot"]), r.choice([None, float(r.randint(0, 9)), r.gauss(0, 1) * 10.0 ** r.randint(-2, 2)]),
                     d0 + dt.timedelta(start), r.choice([None, d0 + dt.timedelta(start + r.randint(1, 9))])))
    df = spark.createDataFrame(rows, "city string, v double, _from date, _until date").withColumn("w", F.col("v") * 2)
    got = {(x.city, x.run_date): (x.m, x.m2) for x in quantiles.running_medians(
        df, ["city"], {"m": "v", "m2": "w"}, F.lit(d0), F.lit(d0 + dt.timedelta(days))).collect()}
    want = {}
    for day in (d0 + dt.timedelta(k) for k in range(days + 1)):
        for city in ("x", None, "hot"):
            vs = sorted(v for c, v, a, b in rows if c == city and v is not None and a <= day and (b is None or b > day))
            if vs:
                a, b = vs[(len(vs) - 1) // 2], vs[len(vs) // 2]
                want[city, day] = (a + (b - a) * 0.5, 2 * a + (2 * b - 2 * a) * 0.5)
    assert got == want


def test_median_with_a_hot_city(spark):
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), (F.col("id") % 50).cast("string"))).alias("city"),
                                      F.lit("S").alias("state_code"), ((F.col("id") * 7919) % 10_007).cast("double").alias("v"))
    import statistics

    got = {r.city: r.m for r in quantile_rows(rows)}
    want = {}
    for r in rows.collect():
        want.setdefault(r.city, []).append(r.v)
    assert got == {c: statistics.median(v) for c, v in want.items()}


def quantile_rows(rows):
    from jobmart.operators.quantiles import grouped_medians

    return grouped_medians(rows, ["city", "state_code"], {"m": "v"}).collect()


def test_null_ids_never_enter_bronze(spark, tmp_root):
    df = spark.createDataFrame([("A", "r", 1, '{"results": [{"title": "x"}, {"id": "1"}]}')], "city string, role string, page int, body string").withColumn("run_date", F.lit("2001-08-01").cast("date"))
    for n in range(2):
        jobs.ingest_pages(spark, df, tmp_root, batch_id=n)
        jobs.compact_bronze(spark, tmp_root)
    assert [r.job_id for r in jobs.bronze_current(spark, tmp_root).collect()] == ["1"]
    assert lifecycle.KEY == ["source", "job_id"] and pages.PULL_KEY == ["run_date", "city", "role"]
