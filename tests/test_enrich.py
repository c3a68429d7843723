"""Payload enrichment: absent vs JSON-null vs malformed, area lengths, dates, quarantine."""

import datetime as dt
import json

from jobmart.operators import silver as S

RUN = "2001-08-01"


def _raw(spark, payloads):
    rows = [("adzuna", str(i), dt.date(2001, 7, 1), dt.date(2001, 8, 1), 2, p) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, "source string, job_id string, first_seen date, last_seen date, "
                                       "times_seen int, payload string")


def _rec(**kw):
    base = {"id": "x", "title": "Senior Analyst", "description": "Remote, 3-5 years",
            "created": "2001-07-30T23:30:00-05:00", "company": {"display_name": "Acme"},
            "category": {"tag": "it", "label": "IT"},
            "location": {"display_name": "Chicago, IL", "area": ["US", "Illinois", "Cook County", "Chicago"]}}
    base.update(kw)
    return json.dumps({k: v for k, v in base.items() if v != "__absent__"})


def test_reasons_and_defaults(spark):
    payloads = [
        _rec(),
        "{not json",
        _rec(title=None),
        _rec(title="__absent__"),
        _rec(description=None),
        _rec(location=None),
        _rec(location={"display_name": "x", "area": None}),
        _rec(company=None),
        _rec(category=None),
        _rec(title=12),
        _rec(location={"area": ["US", "Illinois"]}),
        _rec(location={"area": ["US", "Illinois", "Cook"]}),
        _rec(location={"area": []}),
        _rec(created="not-a-date"),
        "[1, 2]",
    ]
    out = {r.job_id: r for r in S.enrich_first_source(_raw(spark, payloads), RUN).collect()}
    reasons = [out[str(i)].reject_reason for i in range(len(payloads))]
    assert reasons == [None, "malformed_json", "null_title", None, "null_description", "null_location", "null_area",
                       "null_company", "null_category", "bad_title", None, None, None, None, "malformed_json"]
    ok = out["0"]
    assert (ok.city, ok.county, ok.state, ok.state_code) == ("Chicago", "Cook County", "Illinois", "IL")
    assert ok.post_date == dt.date(2001, 7, 30)  # date in the timestamp's own offset
    assert (ok.seniority, ok.is_remote, ok.job_type, ok.is_active) == ("sr", True, "full-time", True)
    assert ok.salary_min is None and ok.industry is None and ok.yoe_min is None
    assert (out["3"].title, out["3"].seniority) == ("", "jr")  # absent title -> '' (not rejected)
    assert (out["10"].city, out["10"].county, out["10"].state) == ("", "", "Illinois")
    assert (out["11"].city, out["11"].county, out["11"].state) == ("", "Cook", "Illinois")
    assert (out["12"].city, out["12"].state, out["12"].state_code) == ("", "", "")
    assert out["13"].post_date is None


def test_split_and_upsert_keep_first_seen(spark):
    raw = _raw(spark, [_rec(), "{bad"])
    good, bad = S.split_valid(S.enrich_first_source(raw, RUN))
    assert good.count() == 1 and [r.reject_reason for r in bad.collect()] == ["malformed_json"]
    target = good.withColumn("first_seen", S.F.lit("2001-01-01").cast("date"))
    merged = S.upsert_silver(target, good.select(*target.columns))
    assert [str(r.first_seen) for r in merged.collect()] == ["2001-01-01"]


def test_enrich_run_is_idempotent(spark):
    raw = _raw(spark, [_rec(), _rec(title="Junior Analyst")])
    empty = S.split_valid(S.enrich_first_source(raw, RUN))[0].limit(0)
    s1, _ = S.enrich_run(raw, empty, RUN)
    s1 = spark.createDataFrame(s1.collect(), s1.schema)
    assert S.work_set(raw, s1).count() == 0
    s2, _ = S.enrich_run(raw, s1, RUN)
    assert sorted(map(tuple, s2.collect())) == sorted(map(tuple, s1.collect()))


def test_area_of_length_five(spark):
    area = ["US", "Illinois", "Cook County", "Chicago", "Loop"]
    out = S.enrich_first_source(_raw(spark, [_rec(location={"display_name": "x", "area": area})]), RUN).first()
    assert (out.city, out.county, out.state, out.state_code, out.reject_reason) == (
        "Loop", "Cook County", "Illinois", "IL", None)


def test_post_date_matches_fromisoformat(spark):
    cases = ["2001-07-31T10:00:00Z", "2001-07-31", "2001-07-31T23:30:00-05:00", "not-a-date", "2001-13-01",
             "2001-07-31 10:00:00", "2001-07-31T10:00:00.123456Z", "2001-07-31T10:00", "20010731T100000", "",
             "2001-02-29T00:00:00Z", "2001-07-31T24:00:00Z", "2001-7-31", "20010731", "20010230", "20010731T1000Z"]

    def py(c):
        if not c:
            return None
        try:
            return dt.datetime.fromisoformat(c.replace("Z", "+00:00")).date()
        except ValueError:
            return None

    got = [r[0] for r in spark.createDataFrame([(c,) for c in cases], "c string")
           .select(S.post_date(S.F.col("c"))).collect()]
    assert got == [py(c) for c in cases]


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

LEAF = st.one_of(st.none(), st.just("__absent__"), st.booleans(), st.integers(-9, 99), st.floats(-1e3, 1e3), st.just([]), st.just({}),
                 st.sampled_from(["", "7", "-1.5", "1e5", "true", "null", "{x", "[y]", "-", "3-5 years", "2001-07-30T10:00:00Z", "20010730", "Sr. {lead}", "é"]))
ODD = st.fixed_dictionaries({}, optional={
    "title": LEAF, "description": LEAF, "created": LEAF, "redirect_url": LEAF, "salary_min": LEAF, "salary_max": st.one_of(LEAF, st.just(1e30), st.just(5.125)),
    "company": st.one_of(LEAF, st.fixed_dictionaries({}, optional={"display_name": LEAF})),
    "category": st.one_of(LEAF, st.fixed_dictionaries({}, optional={"tag": LEAF, "label": LEAF})),
    "location": st.one_of(LEAF, st.fixed_dictionaries({}, optional={
        "display_name": LEAF, "latitude": LEAF, "area": st.one_of(LEAF, st.lists(st.one_of(st.none(), st.integers(0, 5), st.sampled_from(["US", "Illinois", "5", "Cook"])), max_size=5))}))})


@settings(max_examples=8, deadline=None)
@given(st.lists(ODD, min_size=1, max_size=40), st.sampled_from(["", "}", " ", "{", "x"]))
def test_typed_parse_equals_the_variant_checks(spark, odd, tail):
    """Whatever stands in a record, the fast tier gives the rows that the checks of every record would give."""
    payloads = [_rec(**o) for o in odd] + [_rec()[:-1], _rec() + tail, "", "null", "[]", "5", None]
    raw = _raw(spark, payloads)
    rows = [sorted(map(str, S.enrich_first_source(raw, RUN, typed=t).collect())) for t in (True, False)]
    assert rows[0] == rows[1]


def test_usual_records_leave_no_doubt(spark):
    import pyspark.sql.functions as F

    raw = _raw(spark, [_rec(redirect_url="https://x"), _rec(redirect_url="https://x", description="3-5 years"), _rec()])
    parse = F.from_json("payload", S.FIRST_SOURCE_TYPED, {"columnNameOfCorruptRecord": "_corrupt"})
    sure = {r.job_id: r.sure for r in S._once(raw, parse, "_t").select("job_id", S.no_doubt().alias("sure")).collect()}
    assert sure == {"0": True, "1": True, "2": False}  # the last one has no URL: absent or null?


def test_every_generated_method_is_short_enough_to_be_compiled(spark, capsys):
    """The JVM interprets methods above 8,000 bytes of bytecode, row by row, however often they run."""
    import re

    raw = _raw(spark, [_rec()])
    for typed in (True, False):
        rows = S.enrich_first_source(raw, RUN, typed=typed)
        for df in (rows, *S.split_valid(rows)):
            df.explain("codegen")
            sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
            assert sizes and max(sizes) < 8000, sizes


def test_work_set_rows_and_columns(spark):
    """Each bronze row that is new or seen again, once for each older silver row of its key; other sources stay out."""
    d = dt.date
    raw = spark.createDataFrame(
        [("adzuna", "new", 1, d(2001, 8, 1), "p1"), ("adzuna", "again", 2, d(2001, 8, 1), "p2"), ("adzuna", "same", 3, d(2001, 7, 1), "p3"),
         ("adzuna", None, 4, d(2001, 7, 1), "p4"), ("jsearch", "other", 5, d(2001, 8, 1), "p5"), ("adzuna", "unseen", 6, None, "p6")],
        "source string, job_id string, times_seen int, last_seen date, payload string")
    silver = spark.createDataFrame(
        [("adzuna", "again", d(2001, 7, 1)), ("adzuna", "again", d(2001, 7, 2)), ("adzuna", "same", d(2001, 7, 1)), ("adzuna", None, d(2001, 7, 1)),
         ("jsearch", "new", d(2001, 8, 1)), ("adzuna", "unseen", d(2001, 7, 1))], "source string, job_id string, last_seen date")
    out = S.work_set(raw.select("times_seen", "job_id", "source", "last_seen", "payload"), silver)
    assert out.columns == ["source", "job_id", "times_seen", "last_seen", "payload"]
    assert sorted(r.payload for r in out.collect()) == ["p1", "p2", "p2", "p4"]
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert "[job_id" in plan.split("Join", 1)[1]  # sorted by what tells rows apart
