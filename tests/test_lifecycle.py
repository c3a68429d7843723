"""Sighting lifecycle: batch fold == day-by-day upserts == a plain-Python fold."""

import datetime as dt

from pyspark.sql import functions as F

from tests.paths import SF_SMALL
from jobmart.operators import lifecycle as L
from jobmart.sources import adapter

ORDER = ["ts", "event_id"]


def _py_fold(events, refresh=False):
    """The original per-row loop over days in order (first arrival wins; refresh: last wins)."""
    table = {}
    for day in sorted({e["run_date"] for e in events}):
        todays = sorted((e for e in events if e["run_date"] == day), key=lambda e: (e["ts"], e["event_id"]))
        for e in todays:
            key = (e["source"], e["job_id"])
            row = table.get(key)
            if row is None:
                table[key] = [day, day, 1, e["payload"]]
            elif row[1] < day:
                row[1], row[2], row[3] = day, row[2] + 1, e["payload"]
            elif refresh:
                row[3] = e["payload"]
    return {k: tuple(v) for k, v in table.items()}


def _as_dict(df):
    return {(r.source, r.job_id): (r.first_seen, r.last_seen, r.times_seen, r.payload) for r in df.collect()}


def test_batch_equals_python_and_daily_upserts(spark):
    e = adapter.sightings(spark, SF_SMALL)
    events = [r.asDict() for r in e.collect()]
    expected = _py_fold(events)
    assert _as_dict(L.fold_sightings(e)) == expected
    # day by day, each day one batch
    t = L.empty_target(spark)
    for day in sorted({x["run_date"] for x in events}):
        t = L.upsert_sightings(t, e.where(F.col("run_date") == day), ORDER).drop("changed")
        t = spark.createDataFrame(t.collect(), t.schema)  # cut lineage in the test loop
    assert _as_dict(t) == expected


def test_refresh_variant(spark):
    e = adapter.sightings(spark, SF_SMALL)
    expected = _py_fold([r.asDict() for r in e.collect()], refresh=True)
    got = L.upsert_sightings(L.empty_target(spark), e, ORDER, refresh_payload=True).drop("changed")
    assert _as_dict(got) == expected


def test_replay_and_out_of_order_are_noops(spark):
    e = adapter.sightings(spark, SF_SMALL)
    full = L.fold_sightings(e)
    again = L.upsert_sightings(full, e, ORDER)
    assert again.where("changed").count() == 0
    assert _as_dict(again.drop("changed")) == _as_dict(full)
    old_day = e.where(F.col("run_date") == dt.date(2024, 1, 3))
    assert L.upsert_sightings(full, old_day, ORDER).where("changed").count() == 0


def test_invariants(spark):
    t = L.fold_sightings(adapter.sightings(spark, SF_SMALL))
    bad = t.where((F.col("first_seen") > F.col("last_seen"))
                  | (F.col("times_seen") > F.datediff("last_seen", "first_seen") + 1) | (F.col("times_seen") < 1))
    assert bad.count() == 0


def test_first_seen_never_changes(spark):
    e = adapter.sightings(spark, SF_SMALL)
    early = L.fold_sightings(e.where(F.col("run_date") <= dt.date(2024, 1, 10)))
    later = L.upsert_sightings(early, e, ORDER).drop("changed")
    j = early.alias("a").join(later.alias("b"), ["source", "job_id"])
    assert j.where(F.col("a.first_seen") != F.col("b.first_seen")).count() == 0


def test_insert_ignore_and_latest(spark):
    rows = [("adzuna", "1", dt.date(2024, 1, 1), "p1", dt.datetime(2024, 1, 1, 1), 1),
            ("adzuna", "1", dt.date(2024, 1, 1), "p2", dt.datetime(2024, 1, 1, 2), 2),
            ("adzuna", "1", dt.date(2024, 1, 2), "p3", dt.datetime(2024, 1, 2, 1), 3),
            ("adzuna", "2", dt.date(2024, 1, 1), "q1", dt.datetime(2024, 1, 1, 3), 4)]
    batch = spark.createDataFrame(rows, "source string, job_id string, fetched_at date, payload string, "
                                        "ts timestamp, event_id long")
    empty = spark.createDataFrame([], "job_id string, fetched_at date, source string, payload string")
    t1 = L.insert_ignore(empty, batch.where("event_id = 2"), ORDER)
    t2 = L.insert_ignore(t1, batch, ORDER)  # (1, day1) already present: p2 stays
    got = sorted((r.job_id, str(r.fetched_at), r.payload) for r in t2.collect())
    assert got == [("1", "2024-01-01", "p2"), ("1", "2024-01-02", "p3"), ("2", "2024-01-01", "q1")]
    latest = sorted((r.job_id, r.payload) for r in L.latest_version(t2).collect())
    assert latest == [("1", "p3"), ("2", "q1")]


def test_hot_key_third_of_rows(spark):
    """One job id carrying a third of all sightings: same answer as the plain fold."""
    e = adapter.sightings(spark, SF_SMALL)
    hot = e.withColumn("job_id", F.when(F.col("event_id") % 3 == 0, F.lit("HOT")).otherwise(F.col("job_id")))
    events = [r.asDict() for r in hot.collect()]
    assert _as_dict(L.fold_sightings(hot)) == _py_fold(events)
    half = L.fold_sightings(hot.where(F.col("run_date") <= dt.date(2024, 1, 12)))
    assert _as_dict(L.upsert_sightings(half, hot, ORDER).drop("changed")) == _py_fold(events)


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

EVENTS = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(1, 6), st.integers(0, 86399)),
                  min_size=1, max_size=40)


@settings(max_examples=12, deadline=None)
@given(EVENTS, st.integers(1, 6))
def test_upsert_fold_property(spark, events, split_day):
    """Random sighting logs: batch fold == two-batch upsert == the plain day-by-day fold."""
    rows = [{"source": "adzuna", "job_id": k, "run_date": dt.date(2024, 1, d),
             "ts": dt.datetime(2024, 1, d) + dt.timedelta(seconds=s), "event_id": i, "payload": f"p{i}"}
            for i, (k, d, s) in enumerate(events)]
    df = spark.createDataFrame(rows, "source string, job_id string, run_date date, ts timestamp, "
                                     "event_id long, payload string")
    expected = _py_fold(rows)
    assert _as_dict(L.fold_sightings(df)) == expected
    first = L.upsert_sightings(L.empty_target(spark), df.where(F.col("run_date") <= dt.date(2024, 1, split_day)))
    assert _as_dict(L.upsert_sightings(first.drop("changed"), df).drop("changed")) == expected
    # SNK-5 (same-day re-pull refreshes the payload): the whole log as one batch == the plain refresh fold
    refreshed = L.upsert_sightings(L.empty_target(spark), df, refresh_payload=True).drop("changed")
    assert _as_dict(refreshed) == _py_fold(rows, refresh=True)
    part = L.upsert_sightings(L.empty_target(spark), df.where(F.col("run_date") <= dt.date(2024, 1, split_day)),
                              refresh_payload=True).drop("changed")
    again = L.upsert_sightings(part, df, refresh_payload=True).drop("changed")
    assert _as_dict(again) == _py_fold(rows, refresh=True)
