"""SURVEY §5 edge cases on hand-made rows."""

import datetime as dt

from pyspark.sql import functions as F

from jobmart.operators import analysis, gold, housing, lifecycle
from jobmart.sources import pages

RUN = "2001-08-01"
D = dt.date(2001, 8, 1)
OLD = dt.date(2001, 6, 1)
SCHEMA = ("source string, job_id string, title string, description string, city string, state string, "
          "state_code string, category_label string, salary_min double, salary_max double, "
          "first_seen date, last_seen date, times_seen int")


def _silver(spark, rows):
    rows = [tuple(float(v) if isinstance(v, int) and i in (8, 9) else v for i, v in enumerate(r)) for r in rows]
    df = spark.createDataFrame(rows, SCHEMA)
    df = df.withColumns({c: F.col(c).cast("decimal(12,2)") for c in ("salary_min", "salary_max")})
    return gold.classify(df, RUN)


def test_zero_active_city_and_null_salaries(spark):
    rows = [("adzuna", "1", "Analyst", "remote", "Quiet", "X", "QX", "IT", None, None, OLD, OLD, 1),
            ("adzuna", "2", "Analyst", "", "Busy", "Y", "BY", "IT", 100, 200, D, D, 1),
            ("adzuna", "3", "Sr Analyst", "", "Busy", "Y", "BY", "Ops", 300, 500, OLD, D, 5)]
    s = _silver(spark, rows)
    stats = {r.city: r for r in gold.city_job_stats(s, RUN).collect()}
    q = stats["Quiet"]
    assert (q.active_jobs, q.expired_jobs, q.jobs_with_salary) == (0, 1, 0)
    assert q.avg_salary_min is None and q.median_salary_min is None and q.median_salary_max is None
    b = stats["Busy"]
    assert (b.median_salary_min, b.median_salary_max, b.avg_salary_max) == (200.0, 350.0, 350.0)
    snap = {r.city: r for r in gold.latest_city_snapshot(s, RUN).collect()}
    assert snap["Quiet"].top_categories == [] and snap["Quiet"].avg_salary is None
    assert snap["Busy"].top_categories == ["IT", "Ops"]
    assert snap["Quiet"].job_growth_rate_7d == 0.0 and snap["Busy"].job_growth_rate_7d == 100.0
    top = analysis.remote_share(gold.city_job_stats(s, RUN), RUN).collect()
    assert top[0].city == "Quiet" and top[0].remote_percentage is None  # NULLs first, as in the source


def test_regions_sharing_a_name(spark):
    h = spark.createDataFrame(
        [(1, 1, "Springfield", "IL", None, "z", "m", 1000.0, "2001-07-31"),
         (2, 9, "springfield ", "IL", None, "z", "m", 1500.0, "2001-07-31"),
         (3, 2, "Springfield", "MO", None, "z", "m", 800.0, "2001-07-31")],
        "region_id int, size_rank int, region_name string, state_code string, cbsa_code string, "
        "data_source string, metric_type string, metric_value_latest double, date_recorded string")
    look = {(r._rk, r._rs): r.metric_value_latest for r in housing.rent_lookup(h).collect()}
    assert look == {("springfield", "IL"): 1000.0, ("springfield", "MO"): 800.0}  # smallest size rank wins
    s = _silver(spark, [("adzuna", "1", "A", "", "Springfield", "Missouri", "MO", "IT", 1, 2, D, D, 1)])
    m = housing.city_mapping(s, h.where("region_name = 'Springfield'")).collect()
    assert [(r.city, r.state_code, r.region_name) for r in m] == [("Springfield", "MO", "Springfield")]


def test_housing_latest_keeps_null_value(spark):
    wide = spark.createDataFrame([(1, 1, "a", "msa", "S", 1.0, None), (2, 2, "b", "country", "S", 2.0, 3.0)],
                                 "RegionID int, SizeRank int, RegionName string, RegionType string, StateName string, "
                                 "`2001-06-30` double, `2001-07-31` double")
    assert housing.date_columns(wide) == ["2001-06-30", "2001-07-31"]
    out = housing.latest_metric(wide, "z", "m").collect()
    assert [(r.region_id, r.metric_value_latest, r.date_recorded) for r in out] == [(1, None, "2001-07-31")]
    assert housing.long_history(wide, "z", "m").count() == 1  # NULL month dropped from the history


def test_filter_new_and_v1_rows(spark):
    target = spark.createDataFrame([("adzuna", "1", OLD, D, 2, "p"), ("adzuna", "2", OLD, OLD, 1, "q")],
                                   "source string, job_id string, first_seen date, last_seen date, "
                                   "times_seen int, payload string")
    batch = spark.createDataFrame([("1",), ("2",), ("3",)], "job_id string")
    assert sorted(r.job_id for r in lifecycle.filter_new(batch, target, "adzuna", RUN).collect()) == ["2", "3"]
    landed = spark.createDataFrame([(D, "C", "r", 1, '{"count": 1, "results": [{"id": 7}]}')], pages.LANDED_SCHEMA)
    v1 = pages.to_v1_rows(pages.page_records(landed)).collect()
    assert [(r.source, r.job_id, r.fetched_at) for r in v1] == [("adzuna", "7", D)]


def test_region_state_suffix_normaliser(spark):
    h = spark.createDataFrame([(1, 1, "Chicago, IL", "IL", None)],
                              "region_id int, size_rank int, region_name string, state_code string, cbsa_code string")
    s = _silver(spark, [("adzuna", "1", "A", "", "Chicago", "Illinois", "IL", "IT", 1, 2, D, D, 1)])
    assert [r.region_name for r in housing.city_mapping(s, h).collect()] == [None]  # default: as the source
    assert [r.region_name for r in housing.city_mapping(s, h, strip_state_suffix=True).collect()] == ["Chicago, IL"]


def test_api_count_defaults_to_zero(spark):
    landed = spark.createDataFrame([(D, "C", "r", 1, '{"results": [{"id": 1}]}')], pages.LANDED_SCHEMA)
    assert [(r.api_count, r.api_mean_salary) for r in pages.pull_summary(landed).collect()] == [(0, None)]
