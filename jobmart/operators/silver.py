"""Silver: typed, classified postings from the landed JSON payloads.

Parsing has two tiers. Every payload is parsed once with the record's types (``from_json``); a record whose typed
parse holds all texts, none of which might have been another kind of value, needs nothing else. Only a record that
leaves a doubt is parsed again, into a ``VARIANT`` (``try_parse_json``), which keeps the cases apart that the
original code treats differently:

* key absent      -> default (``''``, ``{}``, ``[]``);
* key = JSON null -> NULL for a leaf; the row is rejected where the value is worked on (a text to
  search, an object to look into: the per-row enrich step would raise);
* malformed text, values of the wrong type, missing ids, salaries no column can hold -> rejected by name.

Everything is a projection over the scan (no UDF), so enrichment, validity
split, classification and the keyed upsert run in whole-stage codegen, and the
only shuffle is the (source, job_id) join of the incremental work set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobmart.functions import text as T
from jobmart.operators.lifecycle import KEY

_S = "_s"
# Top-level fields of a first-source record, each kept as VARIANT: an absent key
# is SQL NULL, a JSON null is a variant null.
FIRST_SOURCE_TOP = ("struct<title variant, description variant, company variant, category variant, "
                    "location variant, created variant, redirect_url variant, salary_min variant, "
                    "salary_max variant>")
# The same record with its types; ``_corrupt`` is filled where a value does not fit its type.
FIRST_SOURCE_TYPED = ("title string, description string, company struct<display_name: string>, "
                      "category struct<tag: string, label: string>, location struct<display_name: string, "
                      "area: array<string>, latitude: double, longitude: double>, created string, "
                      "redirect_url string, salary_min double, salary_max double, _corrupt string")
SECOND_SOURCE_TOP = ("struct<job_id variant, job_title variant, job_description variant, employer_name variant, "
                     "job_location variant, job_city variant, job_state variant, employer_company_type variant, "
                     "job_apply_link variant, job_min_salary variant, job_max_salary variant, "
                     "job_posted_at_datetime_utc variant, job_employment_type variant>")


def _field(name: str) -> Column:
    return F.col(f"{_S}.{name}")


def _get(path: str, typ: str = "string") -> Column:
    """``path`` = ``top`` or ``top.rest``: typed value (NULL when absent, null or not castable)."""
    top, _, rest = path.partition(".")
    return F.try_variant_get(_field(top), "$." + rest if rest else "$", typ)


def _is_json_null(path: str) -> Column:
    top, _, rest = path.partition(".")
    v = _field(top) if not rest else F.try_variant_get(_field(top), "$." + rest, "variant")
    return F.coalesce(F.is_variant_null(v), F.lit(False))


def _type_of(top: str) -> Column:
    return F.schema_of_variant(_field(top))


def _text(path: str) -> Column:
    """A string field: ``''`` for an absent key, NULL for a JSON null."""
    return F.when(~_is_json_null(path), F.coalesce(_get(path), F.lit("")))


SALARY_TYPE = "decimal(24,6)"


def _salary(path: str) -> Column:
    return _get(path, "double").try_cast(SALARY_TYPE)


def _not(kind: str, path: str, inner: str) -> Column:
    """Present, not JSON null, and not of the given kind (``OBJECT`` / ``ARRAY``).

    A value that has ``inner`` (a usual key, or the first element) is of the kind; only others are asked for
    their schema, which costs far more than one look-up.
    """
    top, _, rest = path.partition(".")
    v = _field(top) if not rest else F.try_variant_get(_field(top), "$." + rest, "variant")
    return F.when(F.try_variant_get(v, inner, "variant").isNotNull(), F.lit(False)).otherwise(
        v.isNotNull() & ~F.is_variant_null(v) & ~F.schema_of_variant(v).startswith(kind))


def parse_payload(raw: DataFrame, top: str = FIRST_SOURCE_TOP) -> DataFrame:
    """One parse per row into a struct of top-level variants (NULL: malformed / not an object).

    The struct is emitted by a one-element ``explode`` (a Generate) rather than a
    projection: a later filter on the reject reason is then evaluated on the
    generated column instead of being pushed below it with the parse inlined
    once per reference (which would re-parse every document ~10 times).
    """
    parsed = F.try_variant_get(F.try_parse_json(F.col("payload")), "$", top)
    return raw.select("*", F.explode(F.array(parsed)).alias(_S))


# ISO-8601 as accepted by datetime.fromisoformat: extended (2001-07-31T10:00:00+00:00) or
# basic (20010731T100000) form; the date is read in the timestamp's own offset.
_ISO_BASIC = r"^\d{8}(T\d{2}(\d{2}(\d{2}(\.\d{1,6})?)?)?([+-]\d{2}(:?\d{2})?|Z)?)?$"


def post_date(created: Column) -> Column:
    """DAT-1: the calendar date in the timestamp's own offset; unparsable -> NULL."""
    extended = created.rlike(r"^\d{4}-\d{2}-\d{2}") & \
        F.try_to_timestamp(F.replace(created, F.lit("Z"), F.lit("+00:00"))).isNotNull()
    basic = created.rlike(_ISO_BASIC)
    return (F.when(extended, F.try_to_date(F.substring(created, 1, 10)))
            .when(basic, F.try_to_date(F.substring(created, 1, 8), "yyyyMMdd")))


def reject_reason() -> Column:
    """FLT-7: why the per-row enrichment would fail, NULL when the row is good."""
    checks = [
        (F.col(_S).isNull(), "malformed_json"),
        (_is_json_null("title"), "null_title"),
        (F.coalesce(_type_of("title") != "STRING", F.lit(False)), "bad_title"),
        (_is_json_null("description"), "null_description"),
        (F.coalesce(_type_of("description") != "STRING", F.lit(False)), "bad_description"),
        (_is_json_null("location"), "null_location"),
        (_not("OBJECT", "location", "$.area"), "bad_location"),
        (_is_json_null("location.area"), "null_area"),
        (_not("ARRAY", "location.area", "$[0]"), "bad_area"),
        (_is_json_null("company"), "null_company"),
        (_not("OBJECT", "company", "$.display_name"), "bad_company"),
        (_is_json_null("category"), "null_category"),
        (_not("OBJECT", "category", "$.label"), "bad_category"),
        (F.col("job_id").isNull(), "null_id"),
        *[(_get(s, "double").isNotNull() & _salary(s).isNull(), "salary_overflow") for s in ("salary_min", "salary_max")],
    ]
    out = F.when(checks[0][0], checks[0][1])
    for cond, reason in checks[1:]:
        out = out.when(cond, reason)
    return out


_JSON_NUMBER = r"^-?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?$"


def _surely_text(c: Column) -> Column:
    """Not null, and unlike what a typed parse makes of a number, a boolean, an object or a list."""
    first = F.substring(c, 1, 1)
    number = first.isin(*"-0123456789") & c.rlike(_JSON_NUMBER)
    return F.coalesce(~(first.isin("{", "[") | c.isin("true", "false") | number), F.lit(False))


def _typed(path: str) -> Column:
    return F.col(f"_t.{path}")


def no_doubt() -> Column:
    """Whether the typed parse alone settles a record: every text is there and a text, nothing was misfit."""
    texts = ["title", "description", "company.display_name", "location.display_name", "category.tag", "category.label",
             "redirect_url", "created"]
    out = F.col("_t").isNotNull() & _typed("_corrupt").isNull() & F.coalesce(F.endswith("payload", F.lit("}")), F.lit(False))
    for path in texts:
        out = out & _surely_text(_typed(path))
    return out & F.coalesce(F.forall(_typed("location.area"), _surely_text), F.lit(False))


def _checked_fields() -> dict[str, Column]:
    """The fields of a record in doubt, from its variants."""
    return {
        "reject_reason": reject_reason(),
        "title": _text("title"), "description": _text("description"),
        "company": _text("company.display_name"), "location": _text("location.display_name"),
        "_area": F.coalesce(_get("location.area", "array<string>"), F.array().cast("array<string>")),
        "category": _text("category.tag"), "category_label": _text("category.label"),
        "salary_min": _salary("salary_min"), "salary_max": _salary("salary_max"),
        "_created": F.when(_type_of("created") == "STRING", _get("created")),  # a number is no date
        "url": _text("redirect_url"),
        "latitude": _get("location.latitude", "double"), "longitude": _get("location.longitude", "double"),
    }


def _typed_fields() -> dict[str, Column]:
    """The same fields of a record without doubt."""
    salary = {s: _typed(s).try_cast(SALARY_TYPE) for s in ("salary_min", "salary_max")}
    reason = F.when(F.col("job_id").isNull(), "null_id")
    for name, value in salary.items():
        reason = reason.when(_typed(name).isNotNull() & value.isNull(), "salary_overflow")
    return {
        "reject_reason": reason,
        "title": _typed("title"), "description": _typed("description"),
        "company": _typed("company.display_name"), "location": _typed("location.display_name"),
        "_area": _typed("location.area"),
        "category": _typed("category.tag"), "category_label": _typed("category.label"), **salary,
        "_created": _typed("created"), "url": _typed("redirect_url"),
        "latitude": _typed("location.latitude"), "longitude": _typed("location.longitude"),
    }


def _once(df: DataFrame, value: Column, name: str) -> DataFrame:
    """``value`` as a column that later filters and projections do not evaluate again (see :func:`parse_payload`)."""
    return df.select("*", F.explode(F.array(value)).alias(name))


# What is read from a record together. Spark generates one method for each group, and the JVM never compiles a method
# above 8,000 bytes of bytecode but interprets it for every row, which takes twice the time of the whole step.
FIELD_GROUPS = (("reject_reason",), ("title", "description", "company", "location", "category", "category_label", "url"),
                ("_area", "salary_min", "salary_max", "_created", "latitude", "longitude"))


def _struct(fields: dict[str, Column], names: tuple[str, ...]) -> Column:
    return F.struct(*[fields[n].alias(n) for n in names])


def payload_fields(raw: DataFrame, typed: bool = True) -> DataFrame:
    """PRJ-1, JSN-1, FLT-7: the raw columns and the record's fields. ``typed=False`` takes every record by its
    variants; the rows are the same."""
    checked, sure = _checked_fields(), _typed_fields()
    if typed:
        parse = F.from_json("payload", FIRST_SOURCE_TYPED, {"columnNameOfCorruptRecord": "_corrupt"})
        t = _once(raw, parse, "_t").withColumn("_sure", no_doubt())
        variants = F.when(~F.col("_sure"), F.try_variant_get(F.try_parse_json(F.col("payload")), "$", FIRST_SOURCE_TOP))
        out = _once(t, variants, _S)
    else:
        out = parse_payload(raw)
    for i, names in enumerate(FIELD_GROUPS):
        value = _struct(checked, names)
        out = _once(out, F.when(F.col("_sure"), _struct(sure, names)).otherwise(value) if typed else value, f"_f{i}")
    return out.select(*raw.columns, *[f"_f{i}.*" for i in range(len(FIELD_GROUPS))])


def enrich_first_source(raw: DataFrame, run_date, typed: bool = True) -> DataFrame:
    """PRJ-1 (+ JSN-1, ARR-1, DAT-1, JOIN-12, STR-1/5/6): bronze rows -> silver columns.

    Returns all rows with a ``reject_reason`` column (NULL for good rows).
    """
    d = F.lit(str(run_date)).cast("date")
    # 1) pull the fields out of the record once ...
    fields = payload_fields(raw, typed).select(
        *KEY, "first_seen", "last_seen", "times_seen", "reject_reason", "title", "description", "company", "location",
        "_area", F.lit(None).cast("string").alias("cbsa_code"), "category", "category_label", "salary_min", "salary_max",
        "_created", "url", "latitude", "longitude")
    # 2) ... then derive from plain columns.
    area, n = F.col("_area"), F.size("_area")
    state_full = F.when(n >= 2, F.get(area, 1)).otherwise(F.lit(""))
    out = fields.withColumns({
        "city": F.when(n >= 4, F.element_at(area, -1)).otherwise(F.lit("")),
        "county": F.when(n >= 3, F.get(area, 2)).otherwise(F.lit("")),
        "state": state_full,
        "state_code": T.state_code_exact(state_full),
        "post_date": post_date(F.col("_created")),
    }).drop("_area", "_created")
    return out.withColumns({
        "is_active": F.col("last_seen") == d,
        "seniority": T.title_seniority("title"),
        "is_remote": T.is_remote("title", "description"),
        "industry": F.lit(None).cast("string"),
        "job_type": T.job_type_observed("description"),
        "yoe_min": F.lit(None).cast("int"),
        "education": F.lit(None).cast("string"),
    })


def split_valid(enriched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the reason column, rejected (key, reason) rows)."""
    good = enriched.where(F.col("reject_reason").isNull()).drop("reject_reason")
    bad = enriched.where(F.col("reject_reason").isNotNull()).select(*KEY, "reject_reason")
    return good, bad


def work_set(raw: DataFrame, silver: DataFrame, source: str = "adzuna") -> DataFrame:
    """JOIN-1 / FLT-3: bronze rows that are new or seen again since the silver copy."""
    s = silver.select(*KEY, F.col("last_seen").alias("_s_last"))
    # The id comes first: the join sorts by it, and the source is the same in all rows.
    j = raw.where(F.col("source") == source).join(s, ["job_id", "source"], "left")
    due = j.where(F.col("_s_last").isNull() | (F.col("last_seen") > F.col("_s_last")))
    return due.select(*KEY, *[c for c in raw.columns if c not in KEY])


def upsert_silver(target: DataFrame, updates: DataFrame,
                  keep: tuple[str, ...] = ("first_seen", "processed_at")) -> DataFrame:
    """SNK-7: full-row upsert on (source, job_id); ``keep`` columns stay from the target.

    Unmatched target rows are kept as they are, new keys are inserted. If the
    table carries ``updated_at`` / ``processed_at`` (SNK-14), ``updated_at``
    moves to ``current_timestamp()`` on every inserted or matched row and
    ``processed_at`` is set on insert only.
    """
    cols = target.columns
    now = F.current_timestamp()
    stamps = {c: now for c in ("updated_at", "processed_at") if c in cols and c not in updates.columns}
    updates = updates.withColumns(stamps)
    u = updates.select(*KEY, *[F.col(c).alias(f"_u_{c}") for c in cols if c not in KEY])
    m = target.join(u, KEY, "full")
    hit = F.col("_u_last_seen").isNotNull()
    exists = F.col("last_seen").isNotNull()
    sel = []
    for c in cols:
        if c in KEY:
            sel.append(F.col(c))
        elif c in keep:
            sel.append(F.when(exists, F.col(c)).otherwise(F.col(f"_u_{c}")).alias(c))
        else:
            sel.append(F.when(hit, F.col(f"_u_{c}")).otherwise(F.col(c)).alias(c))
    return m.select(*sel)


def mark_active(silver: DataFrame, run_date, source: str = "adzuna") -> DataFrame:
    """SNK-11: ``is_active`` = seen on the run date, for every row of ``source``."""
    d = F.lit(str(run_date)).cast("date")
    other = F.col("is_active") if "is_active" in silver.columns else F.lit(None).cast("boolean")
    return silver.withColumn("is_active", F.when(F.col("source") == source, F.col("last_seen") == d).otherwise(other))


def enrich_run(raw: DataFrame, silver: DataFrame, run_date) -> tuple[DataFrame, DataFrame]:
    """PIP-2: work set -> enrich -> quarantine -> upsert -> activity flags.

    Returns (new silver table, rejected rows). Re-running the same day on the
    result is a no-op: the work set is empty and the flags are recomputed.
    """
    work = work_set(raw, silver)
    good, bad = split_valid(enrich_first_source(work, run_date))
    merged = upsert_silver(silver, good.select(*[c for c in silver.columns if c in good.columns]))
    return mark_active(merged, run_date), bad


# --- v1 enrichers (first source v1, second source) ------------------------------------


def enrich_first_source_v1(raw: DataFrame) -> DataFrame:
    """PRJ-2: v1 rules — city = last area element of any non-empty area, state = code,
    post_date kept as the raw string, seniority from title + description (STR-4).

    Rows the v1 code could not index (area shorter than 3) are flagged in
    ``reject_reason`` instead of failing the whole batch.
    """
    v = parse_payload(raw)
    fields = v.select(
        F.lit("adzuna").alias("source"), "job_id",
        reject_reason().alias("_reason"),
        F.coalesce(_get("location.area", "array<string>"), F.array().cast("array<string>")).alias("_area"),
        _text("title").alias("title"),
        _text("company.display_name").alias("company"),
        _text("location.display_name").alias("location"),
        _text("category.label").alias("category"),
        _text("description").alias("description"),
        _get("created").alias("post_date"),
        _text("redirect_url").alias("url"),
        _get("salary_min", "double").alias("salary_min"),
        _get("salary_max", "double").alias("salary_max"),
    )
    fields = fields.withColumn("_yoe", T.yoe_match(T.joined_lower("title", "description")))
    area, n = F.col("_area"), F.size("_area")
    title, desc = F.col("title"), F.col("description")
    return fields.select(
        "source", "job_id",
        F.when((n > 0) & (n < 3), F.lit("short_area")).otherwise(F.col("_reason")).alias("reject_reason"),
        "title", "company", "location",
        F.when(n > 0, F.element_at(area, -1)).otherwise(F.lit("")).alias("city"),
        F.when(n > 0, F.get(area, 2)).otherwise(F.lit("")).alias("county"),
        F.when(n > 0, T.state_code_exact(F.get(area, 1))).otherwise(F.lit("")).alias("state"),
        "category", "description", "post_date", "url", "salary_min", "salary_max",
        T.seniority_v1(title, desc, "_yoe").alias("seniority"),
        T.is_remote(title, desc).alias("is_remote"),
        T.job_type_observed(desc).alias("job_type"),
    )


def enrich_second_source(raw: DataFrame, run_date) -> DataFrame:
    """PRJ-3 (+ STR-7/8/9, DAT-5): second-source records -> v1 silver columns."""
    v = parse_payload(raw, SECOND_SOURCE_TOP)
    v = v.select("*", _text("job_title").alias("_title"), _text("job_description").alias("_desc"))
    v = v.withColumn("_yoe", T.yoe_match(T.joined_lower("_title", "_desc")))
    title, desc = F.col("_title"), F.col("_desc")
    location = _text("job_location")
    raw_type = _text("job_employment_type")
    posted = _text("job_posted_at_datetime_utc")
    return v.select(
        F.lit("jsearch").alias("source"), "job_id",
        F.when(F.col(_S).isNull(), F.lit("malformed_json")).when(_is_json_null("job_title"), F.lit("null_title"))
        .when(F.coalesce(_type_of("job_title") != "STRING", F.lit(False)), F.lit("bad_title"))
        .when(F.coalesce(~_is_json_null("job_description") & (_type_of("job_description") != "STRING"), F.lit(False)), F.lit("bad_description"))
        .when(F.col("job_id").isNull(), F.lit("null_id")).alias("reject_reason"),
        title.alias("title"),
        _text("employer_name").alias("company"),
        location.alias("location"),
        _text("job_city").alias("city"),
        F.lit("").alias("county"),
        T.second_source_state(_text("job_state"), location).alias("state"),
        _text("employer_company_type").alias("category"),
        desc.alias("description"),
        F.when(posted != "", posted).otherwise(F.lit(str(run_date))).alias("post_date"),
        _text("job_apply_link").alias("url"),
        _get("job_min_salary", "double").alias("salary_min"),
        _get("job_max_salary", "double").alias("salary_max"),
        T.seniority_v1(title, desc, "_yoe").alias("seniority"),
        T.is_remote(title, desc).alias("is_remote"),
        T.standardize_job_type(raw_type, desc, F.lit("jsearch")).alias("job_type"),
    )


def v1_enrichment_batch(bronze_v1: DataFrame, silver_v1_table: DataFrame, source: str, run_date) -> DataFrame:
    """PIP-4 / PIP-5: latest version per job (WIN-1), minus jobs already in silver (JOIN-3),
    enriched with the source's v1 rules; the caller appends the good rows."""
    from jobmart.operators import lifecycle

    latest = lifecycle.not_in_silver(lifecycle.latest_version(bronze_v1), silver_v1_table, source)
    if source == "jsearch":
        return enrich_second_source(latest, run_date)
    return enrich_first_source_v1(latest)


def silver_v1(first_source: DataFrame, second_source: DataFrame) -> DataFrame:
    """SET-1: both v1 enrichers land in one table (``unionByName``)."""
    return first_source.unionByName(second_source)
