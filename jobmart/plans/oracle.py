"""DuckDB oracle SQL for every registered query.

Written independently of the Spark code (plain ANSI SQL over the driver
tables), so a match means two implementations agree. Keyword lists come from
:mod:`jobmart.constants`, the only shared piece.
"""

from __future__ import annotations

from jobmart import constants as K
from jobmart.sources import adapter as A

RUN = K.FIXTURE_RUN_DATE


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _case_mod(key: str, n: int, values, default: str | None = None) -> str:
    whens = " ".join(f"WHEN {i} THEN {_q(v)}" for i, v in enumerate(values))
    other = default if default is not None else _q(values[-1])
    if default is None:
        whens = " ".join(f"WHEN {i} THEN {_q(v)}" for i, v in enumerate(values[:-1]))
    return f"CASE CAST({key} % {n} AS INTEGER) {whens} ELSE {other} END"


def _any(expr: str, words) -> str:
    return "(" + " OR ".join(f"contains({expr}, {_q(w)})" for w in words) + ")"


def seniority_sql(title: str) -> str:
    t = f"lower({title})"
    return (f"CASE WHEN {t} IS NULL THEN NULL WHEN {_any(t, K.SENIOR_TITLE_TAGS)} THEN 'sr' "
            f"WHEN {_any(t, K.MID_TITLE_TAGS)} THEN 'mid' ELSE 'jr' END")


def joined_sql(title: str, desc: str) -> str:
    return f"lower(coalesce({title}, '') || ' ' || coalesce({desc}, ''))"


def remote_sql(title: str, desc: str) -> str:
    return _any(joined_sql(title, desc), K.REMOTE_KEYWORDS)


def job_type_sql(desc: str) -> str:
    return (f"CASE WHEN contains(lower({desc}), 'intern') THEN 'intern' "
            f"WHEN {desc} IS NOT NULL THEN 'full-time' END")


def postings_sql(run: str = RUN) -> str:
    first = "CAST(o_orderdate AS DATE)"
    return f"""
SELECT
  CASE WHEN o_orderkey % 5 = 0 THEN 'jsearch' ELSE 'adzuna' END AS source,
  CAST(o_orderkey AS VARCHAR) AS job_id,
  {_case_mod('o_orderkey', len(A.TITLES), A.TITLES)} AS title,
  {_case_mod('o_orderkey', 7, A.DESCRIPTIONS)} AS description,
  {_case_mod('o_custkey', 7, A.COMPANIES, 'c_name')} AS company,
  n_name AS city,
  r_name AS state_code,
  {_case_mod('c_nationkey', 3, A.STATE_NAMES, 'n_name')} AS state,
  c_mktsegment AS category_label,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(floor(o_totalprice * 0.5) AS DECIMAL(12,2)) END AS salary_min,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_totalprice AS DECIMAL(12,2)) END AS salary_max,
  {first} AS first_seen,
  CASE WHEN o_orderkey % 3 = 0 THEN DATE '{run}'
       ELSE greatest({first}, least({first} + CAST(o_orderkey % 30 AS INTEGER), DATE '{run}' - 1)) END AS last_seen,
  CAST(o_orderkey % 30 + 1 AS INTEGER) AS times_seen
FROM orders JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


def silver_sql(run: str = RUN) -> str:
    return f"""
SELECT *, {seniority_sql('title')} AS seniority, {remote_sql('title', 'description')} AS is_remote,
       {job_type_sql('description')} AS job_type, last_seen = DATE '{run}' AS is_active
FROM ({postings_sql(run)}) j"""


def _avg(x: str) -> str:
    return f"CAST(SUM({x}) AS DOUBLE) / NULLIF(COUNT({x}), 0)"


def stats_sql(run: str = RUN) -> str:
    return f"""
SELECT city, state_code AS state, DATE '{run}' AS run_date,
  COUNT(*) AS total_jobs,
  COUNT(*) FILTER (WHERE is_active) AS active_jobs,
  COUNT(*) FILTER (WHERE first_seen = DATE '{run}') AS new_jobs,
  COUNT(*) FILTER (WHERE NOT is_active AND last_seen < DATE '{run}') AS expired_jobs,
  COUNT(*) FILTER (WHERE salary_min IS NOT NULL) AS jobs_with_salary,
  {_avg('salary_min')} AS avg_salary_min,
  {_avg('salary_max')} AS avg_salary_max,
  quantile_cont(CAST(salary_min AS DOUBLE), 0.5) AS median_salary_min,
  quantile_cont(CAST(salary_max AS DOUBLE), 0.5) AS median_salary_max,
  COUNT(*) FILTER (WHERE is_remote) AS remote_jobs,
  COUNT(*) FILTER (WHERE job_type = 'full-time') AS fulltime_jobs,
  COUNT(*) FILTER (WHERE seniority = 'jr') AS junior_jobs,
  COUNT(*) FILTER (WHERE seniority = 'mid') AS mid_jobs,
  COUNT(*) FILTER (WHERE seniority = 'sr') AS senior_jobs
FROM silver WHERE source = 'adzuna' GROUP BY city, state_code"""


def snapshot_sql(run: str = RUN) -> str:
    d = f"DATE '{run}'"
    both = "salary_min IS NOT NULL AND salary_max IS NOT NULL"

    def growth(n: int) -> str:
        new = f"COUNT(*) FILTER (WHERE first_seen >= {d} - {n})"
        old = f"COUNT(*) FILTER (WHERE first_seen < {d} - {n})"
        return f"CASE WHEN {old} > 0 THEN CAST({new} AS DOUBLE) / {old} * 100 ELSE 0.0 END"

    return f"""
SELECT s.city, s.state_code AS state, active_jobs, new_jobs_7d, new_jobs_30d, avg_salary,
       job_growth_rate_7d, job_growth_rate_30d, coalesce(t.top_categories, '') AS top_categories
FROM (
  SELECT city, state_code,
    COUNT(*) FILTER (WHERE is_active) AS active_jobs,
    COUNT(*) FILTER (WHERE first_seen >= {d} - 7) AS new_jobs_7d,
    COUNT(*) FILTER (WHERE first_seen >= {d} - 30) AS new_jobs_30d,
    CAST(SUM(CASE WHEN {both} THEN salary_min + salary_max END) AS DOUBLE)
      / NULLIF(2 * COUNT(*) FILTER (WHERE {both}), 0) AS avg_salary,
    {growth(7)} AS job_growth_rate_7d,
    {growth(30)} AS job_growth_rate_30d
  FROM silver WHERE source = 'adzuna' GROUP BY city, state_code) s
LEFT JOIN (
  SELECT city, state_code, string_agg(category_label, '|' ORDER BY rn) AS top_categories FROM (
    SELECT city, state_code, category_label,
           row_number() OVER (PARTITION BY city, state_code ORDER BY cnt DESC, category_label) AS rn
    FROM (SELECT city, state_code, category_label, COUNT(*) AS cnt FROM silver
          WHERE is_active AND category_label IS NOT NULL GROUP BY ALL) c) r
  WHERE rn <= {K.TOP_CATEGORIES} GROUP BY city, state_code) t
ON s.city = t.city AND s.state_code = t.state_code"""


def _with(body: str, **ctes: str) -> str:
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in ctes.items()) + "\n" + body


def _pct(a: str, b: str) -> str:
    return f"round(CAST(100 * {a} AS DOUBLE) / NULLIF({b}, 0), 2)"


def _gold(body: str) -> str:
    return _with(body, silver=silver_sql(), stats=stats_sql(), snap=snapshot_sql())


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["city_job_stats"] = _with("SELECT * FROM stats", silver=silver_sql(), stats=stats_sql())
    q["latest_city_snapshot"] = _with("SELECT * FROM snap", silver=silver_sql(), snap=snapshot_sql())
    q["top_cities_active"] = _gold(
        "SELECT city, state, active_jobs, avg_salary, new_jobs_7d, job_growth_rate_7d FROM snap "
        "ORDER BY active_jobs DESC NULLS FIRST, city, state LIMIT 10")
    q["remote_share"] = _gold(
        f"SELECT city, state, active_jobs, remote_jobs, {_pct('remote_jobs', 'active_jobs')} AS remote_percentage "
        f"FROM stats WHERE run_date = DATE '{RUN}' ORDER BY remote_percentage DESC NULLS FIRST, city, state LIMIT 10")
    q["seniority_distribution"] = _gold(
        f"SELECT city, state, junior_jobs, mid_jobs, senior_jobs, {_pct('junior_jobs', 'active_jobs')} AS junior_pct, "
        f"{_pct('mid_jobs', 'active_jobs')} AS mid_pct, {_pct('senior_jobs', 'active_jobs')} AS senior_pct "
        f"FROM stats WHERE run_date = DATE '{RUN}'")
    q["salary_ranges"] = _gold(
        "SELECT city, state, jobs_with_salary, round(avg_salary_min) AS avg_min_salary, "
        "round(avg_salary_max) AS avg_max_salary, round(median_salary_min) AS median_min_salary, "
        f"round(median_salary_max) AS median_max_salary FROM stats WHERE run_date = DATE '{RUN}' "
        "AND jobs_with_salary > 10")
    q["job_persistence"] = _with(
        "SELECT city, state_code, COUNT(*) AS total_jobs, CAST(SUM(times_seen) AS DOUBLE) / COUNT(times_seen) "
        "AS avg_times_seen, COUNT(*) FILTER (WHERE times_seen = 1) AS single_day_jobs, "
        "COUNT(*) FILTER (WHERE times_seen > 7) AS persistent_jobs FROM silver WHERE source = 'adzuna' "
        "GROUP BY city, state_code", silver=silver_sql())
    q["avg_days_active"] = _with(
        "SELECT source, COUNT(*) AS active_jobs, CAST(SUM(last_seen - first_seen) AS DOUBLE) / COUNT(*) "
        "AS avg_days_active FROM silver WHERE is_active GROUP BY source", silver=silver_sql())
    q.update(_sighting_queries())
    q.update(_enrich_queries())
    q.update(_other_queries())
    q.update(_page_queries())
    from jobmart.plans.registry import SUBSETS

    for name, (base, cols) in SUBSETS.items():
        q[name] = f"SELECT {', '.join(cols)} FROM ({q[base]}) b"
    return q


E_SQL = """
SELECT 'adzuna' AS source, CAST(user_id AS VARCHAR) AS job_id, CAST(ts AS DATE) AS run_date, ts, event_id,
       props AS payload, event_type AS city, 'r' || CAST(user_id % 3 AS VARCHAR) AS role, value,
       CASE WHEN hour(ts) < 12 THEN 0 ELSE 1 END AS run
FROM events"""

PAGE_LOG_SQL = """
SELECT run_date, city, role, CAST(job_id AS BIGINT) AS api_count, value AS api_mean_salary, ts AS pulled_at,
       CAST(floor(value) AS INTEGER) AS jobs_retrieved, event_id FROM e"""


def _lifecycle_sql(last_wins: bool) -> str:
    within = "ts DESC, event_id DESC" if last_wins else "ts, event_id"
    return f"""
SELECT a.source, a.job_id, a.first_seen, a.last_seen, a.times_seen, p.payload
FROM (SELECT source, job_id, min(run_date) AS first_seen, max(run_date) AS last_seen,
             CAST(count(DISTINCT run_date) AS INTEGER) AS times_seen FROM e GROUP BY source, job_id) a
JOIN (SELECT source, job_id, payload,
             row_number() OVER (PARTITION BY source, job_id ORDER BY run_date DESC, {within}) AS rn FROM e) p
  ON a.source = p.source AND a.job_id = p.job_id AND p.rn = 1"""


CALLS_SQL = """
SELECT CASE WHEN b.run_date IS NOT NULL THEN b.run_date ELSE a.run_date END AS run_date,
       CASE WHEN b.run_date IS NOT NULL THEN b.city ELSE a.city END AS city,
       CASE WHEN b.run_date IS NOT NULL THEN b.role ELSE a.role END AS role,
       CASE WHEN b.run_date IS NOT NULL THEN b.pages_fetched ELSE a.pages_fetched END AS pages_fetched,
       CASE WHEN b.run_date IS NOT NULL THEN b.api_count ELSE a.api_count END AS api_count,
       CASE WHEN b.run_date IS NOT NULL THEN b.api_mean_salary ELSE a.api_mean_salary END AS api_mean_salary,
       CAST(coalesce(a.jobs_retrieved, 0) + coalesce(b.jobs_retrieved, 0) AS BIGINT) AS jobs_retrieved
FROM (SELECT * FROM pulls WHERE run = 0) a
FULL JOIN (SELECT * FROM pulls WHERE run = 1) b
  ON a.run_date = b.run_date AND a.city = b.city AND a.role = b.role"""

PULLS_SQL = """
SELECT s.*, c.jobs_retrieved FROM (
  SELECT run_date, run, city, role, COUNT(*) AS pages_fetched, COUNT(DISTINCT job_id) AS api_count,
         first(value ORDER BY ts, event_id) AS api_mean_salary FROM e GROUP BY run_date, run, city, role) s
JOIN (
  SELECT run_date, run, city, role, COUNT(*) AS jobs_retrieved FROM (
    SELECT run_date, run, city, role,
           row_number() OVER (PARTITION BY source, job_id, run_date ORDER BY run, city, role) AS rn FROM e) x
  WHERE rn = 1 GROUP BY run_date, run, city, role) c
ON s.run_date = c.run_date AND s.run = c.run AND s.city = c.city AND s.role = c.role
WHERE c.jobs_retrieved > 0"""


def _sighting_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["lifecycle_batch"] = _with("SELECT * FROM life", e=E_SQL, life=_lifecycle_sql(False))
    q["lifecycle_upsert"] = q["lifecycle_batch"]
    q["lifecycle_refresh"] = _with("SELECT * FROM life", e=E_SQL, life=_lifecycle_sql(True))
    q["insert_ignore"] = _with(
        "SELECT job_id, run_date AS fetched_at, source, payload FROM (SELECT *, row_number() OVER "
        "(PARTITION BY job_id, run_date ORDER BY ts, event_id) AS rn FROM e) WHERE rn = 1", e=E_SQL)
    q["latest_version"] = _with(
        "SELECT job_id, source, payload, fetched_at FROM (SELECT job_id, source, payload, run_date AS fetched_at, "
        "row_number() OVER (PARTITION BY job_id ORDER BY run_date DESC, ts, event_id) AS rn FROM e) x "
        "WHERE rn = 1 AND job_id NOT IN (SELECT job_id FROM e WHERE run_date < DATE '2024-01-02')", e=E_SQL)
    q["job_calls_upsert"] = _with("SELECT * FROM calls", e=E_SQL, pulls=PULLS_SQL, calls=CALLS_SQL)
    q["job_calls_consolidate"] = _with(
        "SELECT city, role, run_date, COUNT(*) AS pages_fetched, max(api_count) AS api_count, "
        "max(api_mean_salary) AS api_mean_salary, min(pulled_at) AS pulled_at, max(jobs_retrieved) AS jobs_retrieved "
        "FROM log GROUP BY city, role, run_date", e=E_SQL, log=PAGE_LOG_SQL)
    q["stored_calls"] = _with(
        "SELECT run_date, city, role, COUNT(*) AS pages_fetched, max(api_count) AS api_count, max(api_mean_salary) AS api_mean_salary, "
        "CAST(max(jobs_retrieved) AS BIGINT) AS jobs_retrieved FROM log GROUP BY run_date, city, role", e=E_SQL, log=PAGE_LOG_SQL)
    q["stored_calls_latest"] = _with(
        "SELECT run_date, city, role, CAST(1 AS BIGINT) AS pages_fetched, api_count, api_mean_salary, CAST(jobs_retrieved AS BIGINT) AS jobs_retrieved FROM ("
        "SELECT *, row_number() OVER (PARTITION BY run_date, city, role ORDER BY pulled_at DESC, event_id DESC) AS rn FROM log) x WHERE rn = 1",
        e=E_SQL, log=PAGE_LOG_SQL)
    q["job_calls_duplicates"] = _with(
        "SELECT * FROM log WHERE (run_date, city, role) IN (SELECT (run_date, city, role) FROM log "
        "GROUP BY run_date, city, role HAVING COUNT(*) > 1)", e=E_SQL, log=PAGE_LOG_SQL)
    q["job_calls_keep_latest"] = _with(
        "SELECT run_date, city, role, api_count, api_mean_salary, pulled_at, jobs_retrieved, event_id FROM "
        "(SELECT *, row_number() OVER (PARTITION BY run_date, city, role ORDER BY pulled_at DESC, event_id DESC) "
        "AS rn FROM log) WHERE rn = 1", e=E_SQL, log=PAGE_LOG_SQL)
    q["missing_pulls"] = _with(
        "SELECT g.run_date, g.city, g.role FROM (SELECT DISTINCT run_date, city FROM e) d, "
        "(SELECT unnest(['r0', 'r1', 'r2']) AS role) r, LATERAL (SELECT d.run_date, d.city, r.role) g "
        "WHERE NOT EXISTS (SELECT 1 FROM calls c WHERE c.run_date = g.run_date AND c.city = g.city "
        "AND c.role = g.role)", e=E_SQL, pulls=PULLS_SQL, calls=CALLS_SQL)
    q["market_size"] = _with(
        "SELECT city, role, max(run_date) AS latest_run_date, arg_max(api_count, run_date) AS api_count, "
        "arg_max(api_mean_salary, run_date) AS api_mean_salary, CAST(SUM(jobs_retrieved) AS BIGINT) "
        "AS jobs_retrieved_total FROM calls GROUP BY city, role", e=E_SQL, pulls=PULLS_SQL, calls=CALLS_SQL)
    return q


# --- payload enrichment ------------------------------------------------------------------

def _state_case(expr: str, default: str) -> str:
    return "CASE " + expr + " " + " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in K.US_STATES.items()) + \
        f" ELSE {default} END"


def raw_sql() -> str:
    area = ("CASE WHEN defect = 3 THEN ['US', state] WHEN defect = 4 THEN ['US', state, 'County'] "
            "ELSE ['US', state, 'County', city] END")

    def obj(with_title: bool) -> str:
        title = "'title', CASE WHEN defect = 1 THEN NULL ELSE title END, " if with_title else ""
        return (f"json_object('id', job_id, {title}"
                "'description', CASE WHEN defect = 2 THEN NULL ELSE description END, "
                "'created', CASE WHEN defect = 5 THEN 'not-a-date' ELSE CAST(first_seen AS VARCHAR) || 'T10:00:00Z' END, "
                "'redirect_url', 'https://jobs.example/' || job_id, "
                "'salary_min', CAST(salary_min AS DOUBLE), 'salary_max', CAST(salary_max AS DOUBLE), "
                "'company', json_object('display_name', company), "
                "'category', json_object('tag', lower(category_label), 'label', category_label), "
                "'location', CASE WHEN defect = 6 THEN NULL ELSE json_object('display_name', "
                f"concat_ws(', ', city, state), 'area', {area}) END)")

    texts = " ".join(f"WHEN defect = {n} THEN regexp_replace(CAST({obj(True)} AS VARCHAR), {_q(p)}, {_q(t)}, 'g')"
                     for n, (p, t) in A.TEXT_DEFECTS.items())
    return f"""
SELECT source, job_id, first_seen, last_seen, times_seen,
       CASE WHEN defect = 0 THEN left(CAST({obj(True)} AS VARCHAR), 25)
            WHEN defect = 7 THEN CAST({obj(False)} AS VARCHAR)
            {texts}
            ELSE CAST({obj(True)} AS VARCHAR) END AS payload
FROM (SELECT *, CAST(CAST(job_id AS BIGINT) % 97 AS INTEGER) AS defect FROM ({postings_sql()}) p) x"""


def _pj(src: str) -> str:
    return f"SELECT *, CASE WHEN json_valid(payload) THEN CAST(payload AS JSON) END AS pj FROM {src}"


def _s(path: str) -> str:
    return f"CASE WHEN json_type(pj, '{path}') IS DISTINCT FROM 'NULL' THEN coalesce(json_extract_string(pj, '{path}'), '') END"


REJECT_SQL = """CASE WHEN pj IS NULL THEN 'malformed_json'
  WHEN json_type(pj, '$.title') = 'NULL' THEN 'null_title'
  WHEN json_type(pj, '$.title') <> 'VARCHAR' THEN 'bad_title'
  WHEN json_type(pj, '$.description') = 'NULL' THEN 'null_description'
  WHEN json_type(pj, '$.description') <> 'VARCHAR' THEN 'bad_description'
  WHEN json_type(pj, '$.location') = 'NULL' THEN 'null_location'
  WHEN json_type(pj, '$.location') <> 'OBJECT' THEN 'bad_location'
  WHEN json_type(pj, '$.location.area') = 'NULL' THEN 'null_area'
  WHEN json_type(pj, '$.location.area') <> 'ARRAY' THEN 'bad_area'
  WHEN json_type(pj, '$.company') = 'NULL' THEN 'null_company'
  WHEN json_type(pj, '$.company') <> 'OBJECT' THEN 'bad_company'
  WHEN json_type(pj, '$.category') = 'NULL' THEN 'null_category'
  WHEN json_type(pj, '$.category') <> 'OBJECT' THEN 'bad_category'
  WHEN job_id IS NULL THEN 'null_id'
  WHEN abs(CAST(json_extract(pj, '$.salary_min') AS DOUBLE)) >= 1e18 OR abs(CAST(json_extract(pj, '$.salary_max') AS DOUBLE)) >= 1e18 THEN 'salary_overflow' END"""


def enrich_sql(src: str, run: str = RUN) -> str:
    n = "coalesce(json_array_length(pj, '$.location.area'), 0)"
    created = "CASE WHEN json_type(pj, '$.created') = 'VARCHAR' THEN json_extract_string(pj, '$.created') END"
    return f"""
SELECT source, job_id, first_seen, last_seen, times_seen, reject_reason, title, description, company, location,
       city, county, state, {_state_case('state', "''")} AS state_code, category, category_label,
       salary_min, salary_max, post_date, url, last_seen = DATE '{run}' AS is_active,
       {seniority_sql('title')} AS seniority, {remote_sql('title', 'description')} AS is_remote,
       {job_type_sql('description')} AS job_type
FROM (
  SELECT source, job_id, first_seen, last_seen, times_seen, {REJECT_SQL} AS reject_reason,
         {_s('$.title')} AS title, {_s('$.description')} AS description,
         {_s('$.company.display_name')} AS company, {_s('$.location.display_name')} AS location,
         CASE WHEN {n} >= 4 THEN json_extract_string(pj, '$.location.area[#-1]') ELSE '' END AS city,
         CASE WHEN {n} >= 3 THEN json_extract_string(pj, '$.location.area[2]') ELSE '' END AS county,
         CASE WHEN {n} >= 2 THEN json_extract_string(pj, '$.location.area[1]') ELSE '' END AS state,
         {_s('$.category.tag')} AS category, {_s('$.category.label')} AS category_label,
         CAST(TRY_CAST(CAST(json_extract(pj, '$.salary_min') AS DOUBLE) AS DECIMAL(24,6)) AS DOUBLE) AS salary_min,
         CAST(TRY_CAST(CAST(json_extract(pj, '$.salary_max') AS DOUBLE) AS DECIMAL(24,6)) AS DOUBLE) AS salary_max,
         CASE WHEN coalesce({created}, '') <> ''
               AND try_cast(replace({created}, 'Z', '+00:00') AS TIMESTAMPTZ) IS NOT NULL
              THEN try_cast(left({created}, 10) AS DATE) END AS post_date,
         {_s('$.redirect_url')} AS url
  FROM ({_pj(src)}) r) e"""


SILVER_COLS = ("source, job_id, title, description, company, location, city, county, state, state_code, category, "
               "category_label, salary_min, salary_max, post_date, url, first_seen, last_seen, times_seen, is_active, "
               "seniority, is_remote, job_type")


def seniority_v1_sql(title: str, desc: str) -> str:
    txt = joined_sql(title, desc)
    y = "CAST(coalesce(" + ", ".join(f"nullif(regexp_extract({txt}, '{p}', 1), '')" for p in K.YOE_PATTERNS) + \
        ") AS DOUBLE)"
    t = f"lower({title})"
    lvl = f"regexp_replace(string_split({t}, 'level')[-1], '^\\s+|\\s+$', '', 'g')"
    return (f"CASE WHEN {y} IS NOT NULL THEN (CASE WHEN {y} <= 3 THEN 'jr' WHEN {y} <= 5 THEN 'mid' ELSE 'sr' END) "
            f"WHEN regexp_matches({t}, '{K.V1_LEVEL_PATTERN}') THEN (CASE WHEN {lvl} IN ('i', '1') THEN 'jr' "
            f"WHEN {lvl} IN ('ii', '2') THEN 'mid' ELSE 'sr' END) "
            f"WHEN {_any(txt, K.V1_SENIOR_TAGS)} THEN 'sr' WHEN {_any(t, K.V1_JUNIOR_TAGS)} THEN 'jr' ELSE 'mid' END")


V1_COLS = ("source, job_id, title, company, location, city, county, state, category, description, post_date, url, "
           "salary_min, salary_max, seniority, is_remote, job_type")


def v1_first_sql() -> str:
    n = "coalesce(json_array_length(pj, '$.location.area'), 0)"
    return f"""
SELECT {V1_COLS} FROM (
  SELECT 'adzuna' AS source, job_id,
         CASE WHEN {n} > 0 AND {n} < 3 THEN 'short_area' ELSE {REJECT_SQL} END AS reject_reason,
         {_s('$.title')} AS title, {_s('$.company.display_name')} AS company,
         {_s('$.location.display_name')} AS location,
         CASE WHEN {n} > 0 THEN json_extract_string(pj, '$.location.area[#-1]') ELSE '' END AS city,
         CASE WHEN {n} > 0 THEN json_extract_string(pj, '$.location.area[2]') ELSE '' END AS county,
         CASE WHEN {n} > 0 THEN {_state_case("json_extract_string(pj, '$.location.area[1]')", "''")} ELSE '' END AS state,
         {_s('$.category.label')} AS category, {_s('$.description')} AS description,
         json_extract_string(pj, '$.created') AS post_date, {_s('$.redirect_url')} AS url,
         CAST(json_extract(pj, '$.salary_min') AS DOUBLE) AS salary_min,
         CAST(json_extract(pj, '$.salary_max') AS DOUBLE) AS salary_max,
         {seniority_v1_sql(_s('$.title'), _s('$.description'))} AS seniority,
         {remote_sql(_s('$.title'), _s('$.description'))} AS is_remote,
         {job_type_sql(_s('$.description'))} AS job_type
  FROM ({_pj("raw WHERE source = 'adzuna'")}) r) e
WHERE reject_reason IS NULL"""


def jsearch_raw_sql() -> str:
    k = "CAST(job_id AS BIGINT)"
    return f"""
SELECT source, job_id, CAST(json_object(
  'job_id', job_id, 'job_title', CASE WHEN {k} % 31 <> 0 THEN title END, 'job_description', description, 'employer_name', company,
  'job_location', CASE WHEN {k} % 3 = 0 THEN concat_ws(', ', city, 'IL') ELSE city END,
  'job_city', city,
  'job_state', CASE WHEN {k} % 4 = 0 THEN '' WHEN {k} % 4 = 1 THEN state ELSE state_code END,
  'employer_company_type', category_label, 'job_apply_link', 'https://apply.example/' || job_id,
  'job_min_salary', CAST(salary_min AS DOUBLE), 'job_max_salary', CAST(salary_max AS DOUBLE),
  'job_posted_at_datetime_utc', CASE WHEN {k} % 6 = 0 THEN '' ELSE CAST(first_seen AS VARCHAR) || 'T00:00:00.000Z' END,
  'job_employment_type', CASE CAST(({k} // 5) % 5 AS INTEGER) WHEN 0 THEN 'Full-time and Part-time'
      WHEN 1 THEN 'Contract' WHEN 2 THEN '' WHEN 3 THEN 'Internship' ELSE 'Part-time' END) AS VARCHAR) AS payload
FROM ({postings_sql()}) p WHERE source = 'jsearch'"""


def v1_second_sql(run: str = RUN) -> str:
    st0 = f"coalesce({_state_case(_s('$.job_state'), 'NULL')}, {_s('$.job_state')}, '')"
    loc = _s("$.job_location")
    parts = f"string_split({loc}, ', ')"
    last = f"regexp_replace({parts}[-1], '^\\s+|\\s+$', '', 'g')"
    state = (f"CASE WHEN {st0} = '' AND {loc} <> '' THEN (CASE WHEN len({parts}) >= 2 AND length({last}) = 2 "
             f"THEN {last} ELSE {st0} END) ELSE {st0} END")
    raw_type = _s("$.job_employment_type")
    posted = _s("$.job_posted_at_datetime_utc")
    return f"""
SELECT 'jsearch' AS source, job_id, {_s('$.job_title')} AS title, {_s('$.employer_name')} AS company,
       {loc} AS location, {_s('$.job_city')} AS city, '' AS county, {state} AS state,
       {_s('$.employer_company_type')} AS category, {_s('$.job_description')} AS description,
       CASE WHEN {posted} <> '' THEN {posted} ELSE '{run}' END AS post_date, {_s('$.job_apply_link')} AS url,
       CAST(json_extract(pj, '$.job_min_salary') AS DOUBLE) AS salary_min,
       CAST(json_extract(pj, '$.job_max_salary') AS DOUBLE) AS salary_max,
       {seniority_v1_sql(_s('$.job_title'), _s('$.job_description'))} AS seniority,
       {remote_sql(_s('$.job_title'), _s('$.job_description'))} AS is_remote,
       CASE WHEN {raw_type} <> '' THEN lower(split_part({raw_type}, ' and ', 1)) ELSE 'full-time' END AS job_type
FROM ({_pj('jraw')}) r WHERE pj IS NOT NULL AND json_type(pj, '$.job_title') IS DISTINCT FROM 'NULL'"""


def _enrich_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    base = {"raw": raw_sql()}
    enr = enrich_sql("raw WHERE source = 'adzuna'")
    q["enrich_payload"] = _with(f"SELECT {SILVER_COLS} FROM enr WHERE reject_reason IS NULL", **base, enr=enr)
    q["enrich_rejects"] = _with("SELECT source, job_id, reject_reason FROM enr WHERE reject_reason IS NOT NULL",
                                **base, enr=enr)
    prev = (f"SELECT source, job_id, first_seen, least(last_seen, DATE '2001-07-31') AS last_seen FROM raw "
            f"WHERE source = 'adzuna' AND first_seen <= DATE '2001-07-31'")
    prev_good = (f"SELECT p.* FROM prev p JOIN enr e ON p.source = e.source AND p.job_id = e.job_id "
                 f"WHERE e.reject_reason IS NULL")
    q["incremental_work_set"] = _with(
        "SELECT r.source, r.job_id, r.first_seen, r.last_seen, r.times_seen FROM raw r LEFT JOIN prev_good s "
        "ON r.source = s.source AND r.job_id = s.job_id WHERE r.source = 'adzuna' "
        "AND (s.job_id IS NULL OR r.last_seen > s.last_seen)", **base, enr=enr, prev=prev, prev_good=prev_good)
    q["silver_upsert"] = q["enrich_payload"]
    q["adzuna_v1_enrich"] = _with("SELECT * FROM v1a", **base, v1a=v1_first_sql())
    q["jsearch_enrich"] = _with("SELECT * FROM v1j", jraw=jsearch_raw_sql(), v1j=v1_second_sql())
    q["silver_v1"] = _with("SELECT * FROM v1a UNION ALL SELECT * FROM v1j", **base, v1a=v1_first_sql(),
                           jraw=jsearch_raw_sql(), v1j=v1_second_sql())
    return q


# --- housing, classifiers, maintenance --------------------------------------------------------

def housing_sql() -> str:
    return """
SELECT n_nationkey + 1 AS region_id, n_nationkey AS size_rank, lower(n_name) AS region_name,
       CASE WHEN n_nationkey % 6 = 5 THEN 'country' ELSE 'msa' END AS region_type, r_name AS state_code, n_nationkey AS nation
FROM nation JOIN region ON n_regionkey = r_regionkey"""


MONTHLY_SQL = """
SELECT s_nationkey AS nation, CAST(last_day(CAST(l_shipdate AS DATE)) AS VARCHAR) AS month, round(avg(l_extendedprice) / 30, 2) AS v
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_shipdate IS NOT NULL GROUP BY ALL"""

HLATEST_SQL = f"""
SELECT CAST(region_id AS INTEGER) AS region_id, CAST(size_rank AS INTEGER) AS size_rank, region_name, state_code,
       'zillow_zori' AS data_source, 'rent_index_latest' AS metric_type, m.v AS metric_value_latest,
       (SELECT max(month) FROM ({MONTHLY_SQL}) x) AS date_recorded
FROM h LEFT JOIN ({MONTHLY_SQL}) m ON m.nation = h.nation AND m.month = (SELECT max(month) FROM ({MONTHLY_SQL}) x) WHERE region_type = 'msa'"""


def versions_sql() -> str:
    """What every sighted job looked like on each day it was sighted (first event of the day)."""
    return f"""
SELECT *, {seniority_sql('title')} AS seniority, {remote_sql('title', 'description')} AS is_remote, {job_type_sql('description')} AS job_type FROM (
  SELECT job_id, city, role AS state_code, run_date, min(run_date) OVER (PARTITION BY job_id) AS first_seen,
         CASE WHEN event_id % 7 <> 0 THEN CAST(value AS DECIMAL(12,2)) END AS salary_min,
         CASE WHEN event_id % 7 <> 0 THEN CAST(CAST(value AS DECIMAL(12,2)) * 2 AS DECIMAL(12,2)) END AS salary_max,
         {_case_mod('CAST(job_id AS BIGINT)', len(A.TITLES), A.TITLES)} AS title, {_case_mod('CAST(job_id AS BIGINT)', 7, A.DESCRIPTIONS)} AS description
  FROM (SELECT *, row_number() OVER (PARTITION BY job_id, run_date ORDER BY ts, event_id) AS rn FROM e) x WHERE rn = 1) y"""


# Day by day: the newest version of every job up to that day, then one gold row per city.
STATE_SQL = """
SELECT * FROM (SELECT d.day, v.*, row_number() OVER (PARTITION BY d.day, v.job_id ORDER BY v.run_date DESC) AS rn
FROM (SELECT CAST(t.d AS DATE) AS day FROM generate_series((SELECT min(run_date) FROM v), (SELECT max(run_date) FROM v), INTERVAL 1 DAY) t(d)) d
JOIN v ON v.run_date <= d.day) x WHERE rn = 1"""

HIST_SQL = f"""
SELECT city, state_code AS state, day AS run_date, COUNT(*) AS total_jobs, COUNT(*) FILTER (WHERE run_date = day) AS active_jobs,
       COUNT(*) FILTER (WHERE first_seen = day) AS new_jobs, COUNT(*) FILTER (WHERE run_date < day) AS expired_jobs,
       COUNT(salary_min) AS jobs_with_salary, {_avg('salary_min')} AS avg_salary_min, {_avg('salary_max')} AS avg_salary_max,
       COUNT(*) FILTER (WHERE is_remote) AS remote_jobs, COUNT(*) FILTER (WHERE job_type = 'full-time') AS fulltime_jobs,
       COUNT(*) FILTER (WHERE seniority = 'jr') AS junior_jobs, COUNT(*) FILTER (WHERE seniority = 'mid') AS mid_jobs,
       COUNT(*) FILTER (WHERE seniority = 'sr') AS senior_jobs
FROM st GROUP BY city, state_code, day"""


def _yoe_sql(text: str) -> str:
    return "coalesce(" + ", ".join(f"nullif(regexp_extract({text}, '{p}', 1), '')" for p in K.YOE_PATTERNS) + ")"


def _word_sql(expr: str, pat: str) -> str:
    return f"regexp_matches(coalesce({expr}, ''), '\\b({pat})\\b', 'i')"


def industry_sql() -> str:
    parts = []
    for label, title_pat, comp_pat in K.INDUSTRY_RULES:
        cond = _word_sql("company", comp_pat)
        if title_pat:
            cond = f"({_word_sql('title', title_pat)} OR {cond})"
        parts.append(f"WHEN {cond} THEN '{label}'")
    startup = f"WHEN {_word_sql('company', K.STARTUP_COMPANY_PATTERN)} AND company_postings < {K.STARTUP_MAX_POSTINGS} " \
              "THEN 'startup'"
    return "CASE " + " ".join(parts) + " " + startup + " ELSE 'other' END"


def _other_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["housing_latest"] = _with("SELECT * FROM hl", h=housing_sql(), hl=HLATEST_SQL)
    q["housing_long"] = _with(
        "SELECT CAST(region_id AS INTEGER) AS region_id, region_name, state_code, 'zillow_zori' AS data_source, "
        "'rent_index' AS metric_type, m.month AS date_recorded, m.v AS metric_value FROM h JOIN m ON m.nation = h.nation "
        "WHERE region_type = 'msa' AND m.v IS NOT NULL", h=housing_sql(), m=MONTHLY_SQL)
    q["city_mapping"] = _with(
        "SELECT DISTINCT j.city, j.state, j.state_code, hl.region_name, CAST(NULL AS VARCHAR) AS cbsa_code "
        "FROM silver j LEFT JOIN hl ON lower(j.city) = lower(hl.region_name) AND j.state_code = hl.state_code "
        "WHERE j.is_active", silver=silver_sql(), h=housing_sql(), hl=HLATEST_SQL)
    q["affordability"] = _with(
        "SELECT s.city, s.state, s.avg_salary, hl.metric_value_latest AS zori_latest, "
        "CASE WHEN hl.region_name IS NOT NULL THEN CAST(hl.date_recorded AS DATE) END AS zori_date, "
        "s.avg_salary / hl.metric_value_latest AS salary_to_rent_ratio, "
        "hl.metric_value_latest * 12 <= s.avg_salary * 0.3 AS affordable "
        "FROM snap s LEFT JOIN hl ON lower(s.city) = lower(trim(hl.region_name)) AND s.state = hl.state_code",
        silver=silver_sql(), snap=snapshot_sql(), h=housing_sql(), hl=HLATEST_SQL)
    q["cbsa_lookup"] = _with(
        "SELECT j.source, j.job_id, l.code AS cbsa_code FROM j LEFT JOIN (SELECT lower(trim(lower(r_name))) AS ls, "
        "lower(trim(' ' || n_name || ' ')) AS lc, min(lpad(CAST(n_nationkey * 37 + 10000 AS VARCHAR), 5, '0')) AS code "
        "FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'MIDDLE EAST' GROUP BY 1, 2) l "
        "ON lower(trim(j.state_code)) = l.ls AND lower(trim(j.city)) = l.lc", j=postings_sql())
    t = "lower(title)"
    title_kw = (f"CASE WHEN {_any(t, K.SENIOR_TITLE_TAGS)} THEN 'sr' WHEN {_any(t, K.MID_TITLE_TAGS)} THEN 'mid' "
                f"WHEN {_any(t, K.JUNIOR_TITLE_TAGS)} THEN 'jr' END")
    lo, hi = "CAST(salary_min AS DOUBLE)", "CAST(salary_max AS DOUBLE)"
    band = (f"CASE WHEN {lo} IS NOT NULL AND {hi} IS NOT NULL AND {lo} <> 0 AND {hi} <> 0 THEN "
            f"(CASE WHEN {lo} < {K.SALARY_JUNIOR_BELOW} THEN 'jr' WHEN {lo} > {K.SALARY_SENIOR_ABOVE} THEN 'sr' "
            f"ELSE 'mid' END) END")

    def yband(text: str) -> str:
        y = f"CAST({_yoe_sql(text)} AS DOUBLE)"
        return f"CASE WHEN {y} IS NOT NULL THEN (CASE WHEN {y} <= 3 THEN 'jr' WHEN {y} >= 7 THEN 'sr' ELSE 'mid' END) END"

    d = "lower(coalesce(description, ''))"
    jt_doc = (f"CASE WHEN contains({t}, 'intern') THEN 'intern' WHEN contains({d}, 'part time') THEN 'part-time' "
              f"WHEN contains({d}, 'full time') THEN 'full-time' WHEN contains({d}, 'contract') THEN 'contract' "
              "ELSE 'full-time' END")
    q["classify_postings"] = _with(
        f"SELECT source, job_id, {seniority_sql('title')} AS seniority, "
        f"coalesce({title_kw}, {band}, {yband('description')}, 'mid') AS seniority_documented, "
        f"{seniority_v1_sql('title', 'description')} AS seniority_v1, {band} AS salary_band, "
        f"TRY_CAST({_yoe_sql('lower(description)')} AS BIGINT) AS yoe_min, {yband('lower(description)')} AS yoe_band, "
        f"{remote_sql('title', 'description')} AS is_remote, {job_type_sql('description')} AS job_type, "
        f"{jt_doc} AS job_type_documented FROM j", j=postings_sql())
    q["industry"] = _with(
        f"SELECT source, job_id, {industry_sql()} AS industry FROM (SELECT j.*, c.company_postings FROM j "
        "LEFT JOIN (SELECT company, COUNT(*) AS company_postings FROM j GROUP BY company) c "
        "ON j.company = c.company) x", j=postings_sql())
    txt = joined_sql("title", "description")
    hint = "CASE " + " ".join(f"WHEN {_any(txt, words)} THEN '{label}'" for label, words in K.INDUSTRY_HINTS) + \
        " ELSE coalesce(category_label, '') END"
    edu = (f"CASE WHEN regexp_matches({d}, '\\b(bachelor|ba/bs|bs/ba|b\\.s\\.|b\\.a\\.)') THEN {_q(chr(98) + 'achelor' + chr(39) + 's')} "
           f"WHEN regexp_matches({d}, '\\b(master|ms/|m\\.s\\.|mba)') THEN {_q('master' + chr(39) + 's')} "
           f"WHEN regexp_matches({d}, '\\b(phd|ph\\.d|doctorate)') THEN 'phd' END")
    q["industry_hints"] = _with(f"SELECT source, job_id, {hint} AS industry_hint, {edu} AS education FROM j",
                                j=postings_sql())
    low = "lower(title)"
    q["classify_documents"] = _with(
        f"SELECT doc_id, {seniority_sql('title')} AS seniority, coalesce({title_kw}, {yband(low)}, 'mid') AS seniority_documented, "
        f"{seniority_v1_sql('title', 'NULL')} AS seniority_v1, {remote_sql('title', 'NULL')} AS is_remote, "
        f"TRY_CAST({_yoe_sql(low)} AS BIGINT) AS yoe_min, {yband(low)} AS yoe_band, {job_type_sql('title')} AS job_type, "
        f"{jt_doc} AS job_type_documented, {industry_sql()} AS industry, {hint} AS industry_hint, {edu} AS education FROM d",
        d="SELECT doc_id, text AS title, text AS description, text AS company, source AS category_label, 0 AS company_postings FROM documents")
    codes = ", ".join(_q(v) for v in K.US_STATES.values())
    lower_map = "CASE lower(trim(state_input)) " + " ".join(
        f"WHEN {_q(k.lower())} THEN {_q(v)}" for k, v in K.US_STATES.items()) + " END"
    q["state_abbrev"] = _with(
        f"SELECT state_input, CASE WHEN state_input IS NULL OR state_input = '' THEN '' "
        f"WHEN length(lower(trim(state_input))) = 2 AND upper(lower(trim(state_input))) IN ({codes}) "
        f"THEN upper(lower(trim(state_input))) ELSE coalesce({lower_map}, state_input) END AS state_abbrev "
        "FROM (SELECT DISTINCT unnest([state, lower(state), upper(state), '  ' || state || ' ', substring(state, 1, 2), "
        "upper(substring(state, 1, 2)), state_code]) AS state_input FROM j) v", j=postings_sql())
    raw = "concat_ws(', ', city, state_code)"
    q["location"] = _with(
        f"SELECT source, job_id, CASE WHEN source = 'adzuna' THEN (CASE WHEN city <> '' AND state <> '' "
        f"THEN city || ', ' || state ELSE {raw} END) WHEN source = 'jsearch' THEN {raw} END AS location, "
        "CASE WHEN source = 'adzuna' THEN 'County' WHEN source = 'jsearch' THEN '' END AS county FROM j",
        j=postings_sql())
    chg = (f"SELECT source, job_id, title, CASE WHEN description <> '' THEN {seniority_v1_sql('title', 'description')} "
           f"END AS old_s, {seniority_sql('title')} AS new_s FROM j")
    q["seniority_backfill_matrix"] = _with(
        "SELECT change_type, COUNT(*) AS n_jobs FROM (SELECT CASE WHEN old_s IS NULL THEN 'null_to_value' "
        "WHEN old_s = new_s THEN 'no_change' WHEN old_s IN ('jr', 'mid', 'sr') AND new_s IN ('jr', 'mid', 'sr') "
        "THEN old_s || ' → ' || new_s ELSE 'other_changes' END AS change_type FROM chg) c "
        "GROUP BY change_type", j=postings_sql(), chg=chg)
    q["seniority_backfill_sample"] = _with(
        "SELECT CASE WHEN length(job_id) > 15 THEN left(job_id, 12) || '...' ELSE job_id END AS job_id, "
        "CASE WHEN length(title) > 40 THEN left(title, 37) || '...' ELSE title END AS title, "
        "coalesce(old_s, 'NULL') AS old_seniority, new_s AS new_seniority FROM chg "
        "WHERE old_s IS DISTINCT FROM new_s ORDER BY chg.job_id LIMIT 10", j=postings_sql(), chg=chg)
    kept = "CAST(job_id AS BIGINT) % 3 = 0"
    q["description_backfill"] = _with(
        f"SELECT COUNT(*) FILTER (WHERE NOT {kept} OR description IS NULL) AS jobs_needing_descriptions, "
        f"COUNT(*) FILTER (WHERE NOT {kept} OR description IS NULL) AS updated, "
        f"COUNT(*) FILTER (WHERE {kept} OR description <> '') AS jobs_with_descriptions, "
        f"COUNT(*) FILTER (WHERE NOT {kept} AND coalesce(description, '') = '') AS jobs_still_missing "
        "FROM enr WHERE reject_reason IS NULL", raw=raw_sql(), enr=enrich_sql("raw WHERE source = 'adzuna'"))
    q["description_backfill_table"] = _with(
        f"SELECT source, job_id, CASE WHEN {kept} THEN 'kept ' || description ELSE description END AS description "
        "FROM enr WHERE reject_reason IS NULL", raw=raw_sql(), enr=enrich_sql("raw WHERE source = 'adzuna'"))
    nn_s = ["source", "job_id", "title", "first_seen", "last_seen"]
    nn_g = ["city", "state", "run_date", "total_jobs", "active_jobs", "new_jobs", "expired_jobs"]

    def dq(table: str, src: str, keys: list[str], nn: list[str], dom: dict) -> str:
        k = ", ".join(keys)
        rows = [f"SELECT '{table}' AS table_name, 'duplicate_key' AS check_name, '{','.join(keys)}' AS column_name, "
                f"CAST(coalesce((SELECT SUM(n - 1) FROM (SELECT COUNT(*) AS n FROM {src} GROUP BY {k}) x "
                f"WHERE n > 1), 0) AS BIGINT) AS violations"]
        rows += [f"SELECT '{table}', 'not_null', '{c}', COUNT(*) FILTER (WHERE {c} IS NULL) FROM {src}" for c in nn]
        rows += [f"SELECT '{table}', 'domain', '{c}', COUNT(*) FILTER (WHERE NOT ({c} IN ({', '.join(map(_q, vals))}))) "
                 f"FROM {src}" for c, vals in dom.items()]
        return " UNION ALL ".join(rows)

    q["dq_report"] = _with(
        dq("silver.jobs_v2", "silver", ["source", "job_id"], nn_s, {"seniority": ["jr", "mid", "sr"]}) + " UNION ALL " +
        dq("gold.city_job_stats", "stats", ["city", "state", "run_date"], nn_g, {}),
        silver=silver_sql(), stats=stats_sql())
    both = "salary_min IS NOT NULL AND salary_max IS NOT NULL"
    q["posting_trends"] = _with(
        f"SELECT first_seen AS date, city, source, COUNT(*) AS job_count, "
        f"CAST(SUM(CASE WHEN {both} THEN salary_min + salary_max END) AS DOUBLE) "
        f"/ NULLIF(2 * COUNT(*) FILTER (WHERE {both}), 0) AS avg_salary FROM silver GROUP BY first_seen, city, source",
        silver=silver_sql())

    def chg_pct(a: str, b: str) -> str:
        return f"round(CAST(({a} - {b}) * 100 AS DOUBLE) / NULLIF({b}, 0), 2)"

    q["wow_change"] = _with(
        "SELECT a.city, a.state, a.run_date, a.active_jobs, w.active_jobs AS active_jobs_7d_ago, "
        f"{chg_pct('a.active_jobs', 'w.active_jobs')} AS week_over_week_change, "
        f"m.active_jobs AS active_jobs_30d_ago, {chg_pct('a.active_jobs', 'm.active_jobs')} AS month_over_month_change "
        "FROM hist a LEFT JOIN hist w ON w.city = a.city AND w.state = a.state AND w.run_date = a.run_date - 7 "
        "LEFT JOIN hist m ON m.city = a.city AND m.state = a.state AND m.run_date = a.run_date - 30",
        e=E_SQL, v=versions_sql(), st=STATE_SQL, hist=HIST_SQL)
    q["city_history"] = _with("SELECT * FROM hist", e=E_SQL, v=versions_sql(), st=STATE_SQL, hist=HIST_SQL)
    q["city_trend"] = _with(
        "SELECT * FROM (SELECT city, state, run_date, total_jobs, active_jobs, new_jobs, avg_salary_min, avg_salary_max, "
        "active_jobs - lag(active_jobs) OVER (PARTITION BY city, state ORDER BY run_date) AS active_change FROM hist) h "
        "QUALIFY row_number() OVER (PARTITION BY city, state ORDER BY run_date DESC) <= 30",
        e=E_SQL, v=versions_sql(), st=STATE_SQL, hist=HIST_SQL)
    q["filter_new"] = _with(
        "SELECT job_id, event_id FROM e WHERE run_date = DATE '2024-01-15' AND job_id NOT IN "
        "(SELECT job_id FROM e WHERE run_date = DATE '2024-01-15' AND hour(ts) < 12)", e=E_SQL)
    q["second_source_pages"] = _with(
        f"SELECT DATE '{RUN}' AS run_date, city, 'r' || CAST(CAST(job_id AS BIGINT) // 30000 AS VARCHAR) AS role, "
        "CAST(1 + (CAST(job_id AS BIGINT) // 500) % 24 AS INTEGER) AS page, source, job_id, title FROM j "
        f"WHERE source = 'jsearch' AND last_seen = DATE '{RUN}'", j=postings_sql())
    q["city_score_inputs"] = _with(
        "SELECT s.city, s.state, s.total_jobs, s.avg_salary_max, "
        "round(CAST(100 * s.remote_jobs AS DOUBLE) / NULLIF(s.total_jobs, 0), 2) AS remote_share, "
        "hl.metric_value_latest AS rent_index FROM stats s LEFT JOIN hl "
        "ON lower(trim(s.city)) = lower(trim(hl.region_name)) AND s.state = hl.state_code",
        silver=silver_sql(), stats=stats_sql(), h=housing_sql(), hl=HLATEST_SQL)
    asof = "TIMESTAMP '2024-01-15 12:00:00'"
    stamped = f"CASE WHEN ts < {asof} - INTERVAL 1 HOUR THEN {asof} ELSE ts END"
    q["restamp_stale"] = (f"SELECT event_id, {stamped} AS processed_at, "
                          f"CAST({stamped} AS DATE) = DATE '2024-01-15' AS fetched_today FROM events")
    return q


def _page_queries() -> dict[str, str]:
    k = "CAST(job_id AS BIGINT)"
    p = (f"SELECT *, {k} // 30000 AS bucket, CAST(1 + ({k} // 500) % 24 AS INTEGER) AS page FROM j "
         f"WHERE source = 'adzuna' AND last_seen = DATE '{RUN}'")
    pulls = ("SELECT city, bucket, COUNT(*) AS api_count, max(CAST(salary_max AS DOUBLE)) AS api_mean_salary, "
             "bool_or(page = 1) AS has_first FROM p GROUP BY city, bucket")
    good = ("SELECT DISTINCT city, bucket, page FROM p WHERE page <= 20 AND NOT "
            "(((bucket + ascii(right(city, 1))) % 3 = 0 AND page = 9) OR ((bucket + ascii(right(city, 1))) % 3 = 1 AND page = 5))")
    cut = ("SELECT u.city, u.bucket, min(s.s) AS cutoff FROM pulls u CROSS JOIN generate_series(1, 21) s(s) "
           "WHERE NOT EXISTS (SELECT 1 FROM good g WHERE g.city = u.city AND g.bucket = u.bucket AND g.page = s.s) "
           "GROUP BY u.city, u.bucket")
    kept = (f"SELECT DATE '{RUN}' AS run_date, p.city, 'r' || CAST(p.bucket AS VARCHAR) AS role, p.page, p.job_id, "
            "c.cutoff, p.bucket FROM p JOIN cut c ON p.city = c.city AND p.bucket = c.bucket WHERE p.page < c.cutoff")
    every = (f"SELECT DATE '{RUN}' AS run_date, city, 'r' || CAST(bucket AS VARCHAR) AS role, page, job_id, bucket, title, city AS c, salary_max FROM p "
             "WHERE NOT (((bucket + ascii(right(city, 1))) % 3 = 0 AND page = 9) OR ((bucket + ascii(right(city, 1))) % 3 = 1 AND page = 5))")
    ctes = dict(j=postings_sql(), p=p, pulls=pulls, good=good, cut=cut, kept=kept)
    every_ctes = dict(j=postings_sql(), p=p, pulls=pulls, every=every)
    return {
        "v1_envelope": _with(
            "SELECT 'adzuna' AS source, job_id, run_date AS fetched_at, page, "
            "CAST(row_number() OVER (PARTITION BY city, bucket, page ORDER BY job_id) - 1 AS INTEGER) AS position, "
            "job_id AS payload_id, title AS payload_title, c AS payload_city, CAST(salary_max AS DOUBLE) AS payload_salary_max "
            "FROM every", **every_ctes),
        "stored_bronze": _with(
            "SELECT DISTINCT 'adzuna' AS source, job_id, run_date AS first_seen, run_date AS last_seen, CAST(1 AS INTEGER) AS times_seen FROM every",
            **every_ctes),
        "run_report": _with(
            f"SELECT (SELECT COUNT(*) FROM j WHERE source = 'adzuna' AND last_seen = DATE '{RUN}') AS raw_jobs_seen, "
            "(SELECT COUNT(*) FROM every) AS v1_rows_fetched, "
            "(SELECT COUNT(*) FROM (SELECT DISTINCT city, bucket FROM every) x) AS calls_recorded", **every_ctes),
        "seen_today": _with(f"SELECT job_id FROM j WHERE source = 'adzuna' AND last_seen = DATE '{RUN}'",
                            j=postings_sql()),
        "page_cutoff": _with("SELECT run_date, city, role, page, job_id FROM kept", **ctes),
        "page_pulls": _with(
            "SELECT k.run_date, k.city, k.role, CAST(max(k.page) AS INTEGER) AS pages_fetched, "
            "max(CASE WHEN u.has_first THEN u.api_count END) AS api_count, max(CASE WHEN u.has_first THEN u.api_mean_salary END) AS api_mean_salary, "
            "COUNT(*) AS postings FROM every k JOIN pulls u ON k.city = u.city AND k.bucket = u.bucket "
            "GROUP BY k.run_date, k.city, k.role", **every_ctes),
    }
