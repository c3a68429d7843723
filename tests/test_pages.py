"""Landed pages: prefix-closed pagination, page limit, API metadata from page 1."""

import datetime as dt
import json

from jobmart.sources import pages


def _env(ids, count=99, mean=1.5):
    return json.dumps({"count": count, "mean": mean, "results": [{"id": i, "title": "t"} for i in ids]})


def test_cutoff_rules(spark):
    d = dt.date(2024, 1, 1)
    rows = [
        (d, "A", "r", 1, _env([1, 2])), (d, "A", "r", 2, _env([3])), (d, "A", "r", 3, _env([])),
        (d, "A", "r", 4, _env([4])),                      # after an empty page: dropped
        (d, "B", "r", 1, _env([5])), (d, "B", "r", 3, _env([6])),   # gap at page 2
        (d, "C", "r", 1, "{broken"), (d, "C", "r", 2, _env([7])),   # corrupt first page
    ] + [(d, "D", "r", p, _env([100 + p])) for p in range(1, 23)]   # beyond the 20-page limit
    landed = spark.createDataFrame(rows, pages.LANDED_SCHEMA)
    recs = pages.page_records(landed, max_pages=20)
    got = sorted((r.city, r.page, r.job_id) for r in recs.collect())
    exp = [("A", 1, "1"), ("A", 1, "2"), ("A", 2, "3"), ("B", 1, "5")] + [("D", p, str(100 + p)) for p in range(1, 21)]
    assert got == sorted(exp)
    summ = {r.city: (r.pages_fetched, r.api_count, r.postings) for r in pages.pull_summary(landed, max_pages=20).collect()}
    assert summ == {"A": (2, 99, 3), "B": (1, 99, 1), "D": (20, 99, 20)}


def test_second_source_envelope(spark):
    d = dt.date(2024, 1, 1)
    body = json.dumps({"data": [{"job_id": "j1", "job_title": "Analyst"}, {"job_id": "j2"}]})
    rows = [(d, "A", "r", 1, body), (d, "A", "r", 2, body),          # only one page per pull is used
            (d, "B", "r", 1, "<html>error</html>")]                 # a failed call yields nothing
    landed = spark.createDataFrame(rows, pages.LANDED_SCHEMA)
    recs = pages.page_records(landed, records_path="$.data", max_pages=1, source="jsearch")
    got = sorted((r.city, r.page, r.position, r.source, r.job_id) for r in recs.collect())
    assert got == [("A", 1, 0, "jsearch", "j1"), ("A", 1, 1, "jsearch", "j2")]


def test_raw_response_files(spark, tmp_root):
    import os

    for city, page, body in [("Chicago", 1, _env([1, 2])), ("Chicago", 2, _env([])), ("Detroit", 1, _env([3]))]:
        d = os.path.join(tmp_root, "run_date=2024-01-01", f"city={city}", "role=data analyst", f"page={page}")
        os.makedirs(d)
        with open(os.path.join(d, "response.json"), "w") as f:
            f.write(json.dumps(json.loads(body), indent=2))  # multi-line raw file
    landed = pages.read_landed_files(spark, tmp_root)
    got = sorted((r.city, r.role, r.page, r.job_id) for r in pages.page_records(landed, max_pages=20).collect())
    assert got == [("Chicago", "data analyst", 1, "1"), ("Chicago", "data analyst", 1, "2"),
                   ("Detroit", "data analyst", 1, "3")]


def test_pull_order_follows_pulled_at(spark):
    """A posting found by two pulls on one day is credited to the pull that ran first."""
    from jobmart.operators import lifecycle as L
    from jobmart.plans import jobs

    d = dt.date(2024, 1, 1)
    rows = [(d, "Zeta", "r", 1, _env([1]), dt.datetime(2024, 1, 1, 8)),    # ran first, sorts last by name
            (d, "Alpha", "r", 1, _env([1]), dt.datetime(2024, 1, 1, 9))]
    landed = spark.createDataFrame(rows, pages.LANDED_READ_SCHEMA)
    batch = pages.page_records(landed, max_pages=20).select("source", "job_id", "run_date", "payload", *jobs.PULL_ORDER)
    credit = jobs.credited_pulls(batch, L.empty_target(spark)).collect()
    assert [(r.city, r.jobs_retrieved) for r in credit] == [("Zeta", 1)]


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

STATUS = st.sampled_from(["ok", "ok", "ok", "empty", "corrupt", "missing"])


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(STATUS, min_size=1, max_size=23), min_size=1, max_size=4))
def test_prefix_rule_property(spark, pulls):
    """Kept pages == plain statement of the rule: stop at the first missing / empty / corrupt
    page, never beyond page 20."""
    d = dt.date(2024, 1, 1)
    rows, expected = [], set()
    for c, statuses in enumerate(pulls):
        stopped = False
        for p, status in enumerate(statuses, start=1):
            rid = c * 100 + p
            if status != "missing":
                body = _env([rid]) if status == "ok" else _env([]) if status == "empty" else "{nope"
                rows.append((d, f"C{c}", "r", p, body))
            if not stopped and status == "ok" and p <= 20:
                expected.add((f"C{c}", p))
            else:
                stopped = True
    if not rows:
        return
    got = {(r.city, r.page) for r in pages.page_records(spark.createDataFrame(rows, pages.LANDED_SCHEMA), max_pages=20).collect()}
    assert got == expected
