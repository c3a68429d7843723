"""Maintenance, backfill and data-quality jobs (set-based, no per-row loops).

A backfill is: recompute -> compare old vs new -> report -> keyed update.
The report and the update are separate DataFrames over the same comparison,
so a dry run is just "do not write the update".
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobmart.functions import text as T
from jobmart.operators.lifecycle import KEY

SENIORITY_LEVELS = ("jr", "mid", "sr")


def seniority_changes(silver: DataFrame, new_value: Column, current: str = "seniority") -> DataFrame:
    """PIP-7 step 2: (key, title, old, new, changed, change_type) per posting."""
    # Compute both classifications once as columns, then compare the columns.
    cmp = silver.select(*KEY, "title", F.col(current).alias("old_seniority"), new_value.alias("new_seniority"))
    old, new = F.col("old_seniority"), F.col("new_seniority")
    label = (F.when(old.isNull(), F.lit("null_to_value"))
             .when(old == new, F.lit("no_change"))
             .otherwise(F.concat(old, F.lit(" → "), new)))
    return cmp.select(*KEY, "title", "old_seniority", "new_seniority",
                      (~old.eqNullSafe(new)).alias("changed"), label.alias("change_type"))


def transition_matrix(changes: DataFrame) -> DataFrame:
    """AGG-14 / DQ-5: count per tracked change type; all others count as ``other_changes``."""
    tracked = [f"{a} → {b}" for a in SENIORITY_LEVELS for b in SENIORITY_LEVELS if a != b]
    tracked += ["no_change", "null_to_value"]
    kind = F.when(F.col("change_type").isin(tracked), F.col("change_type")).otherwise("other_changes")
    return changes.groupBy(kind.alias("change_type")).agg(F.count("*").alias("n_jobs"))


def change_sample(changes: DataFrame, k: int = 10) -> DataFrame:
    """SRT-6 / STR-17: the first k changed postings by job id, display-truncated."""
    return (changes.where(F.col("changed")).orderBy("job_id").limit(k)
            .select(T.truncate_display("job_id", 15, 12).alias("job_id"),
                    T.truncate_display("title", 40, 37).alias("title"),
                    F.coalesce("old_seniority", F.lit("NULL")).alias("old_seniority"),
                    "new_seniority"))


def backfill_seniority(silver: DataFrame, new_value: Column, dry_run: bool = True, k: int = 10) -> dict:
    """PIP-7: recompute seniority, report the transition matrix and a sample; when not a
    dry run also return the updated table (``updated_at`` moved on changed rows)."""
    changes = seniority_changes(silver, new_value)
    out = {"matrix": transition_matrix(changes), "sample": change_sample(changes, k),
           "n_changes": changes.where(F.col("changed"))}
    if not dry_run:  # the new value is a function of the row itself: one projection, no join
        changed = ~F.col("seniority").eqNullSafe(new_value)
        stamps = {"updated_at": F.when(changed, F.current_timestamp()).otherwise(F.col("updated_at"))} if "updated_at" in silver.columns else {}
        out["table"] = silver.withColumns({**stamps, "seniority": new_value})
    return out


def apply_column_update(target: DataFrame, updates: DataFrame, column: str) -> DataFrame:
    """SNK-12: keyed column update (``updates`` = key + new value); other rows unchanged."""
    u = updates.select(*KEY, F.col(column).alias("_new"), F.lit(True).alias("_hit"))
    j = target.join(u, KEY, "left")
    return j.withColumn(column, F.when(F.col("_hit"), F.col("_new")).otherwise(F.col(column))).drop("_new", "_hit")


def _missing(c: Column) -> Column:
    return c.isNull() | (c == "")


def missing_text(col: str) -> Column:
    """FLT-4: null or empty."""
    return F.coalesce(_missing(F.col(col)), F.lit(True))


def payload_descriptions(raw: DataFrame) -> DataFrame:
    """JSN-4: KEY and the description of each payload as ``value`` ('' for none, NULL for a JSON null)."""
    v = raw.select(*KEY, F.try_parse_json("payload").alias("_v"))
    value = F.when(F.col("_v").isNull(), F.lit("")).when(
        F.is_variant_null(F.expr("variant_get(_v, '$.description')")), F.lit(None).cast("string")).otherwise(
        F.coalesce(F.try_variant_get("_v", "$.description", "string"), F.lit("")))
    return v.select(*KEY, value.alias("value"))


def description_backfill(silver: DataFrame, raw: DataFrame, source: str = "adzuna") -> tuple[DataFrame, DataFrame]:
    """PIP-8: fill missing descriptions from the bronze payload.

    JOIN-5 (inner join silver ⋈ bronze) + FLT-4 + JSN-4; returns (new silver,
    one-row report with the before/after counts of AGG-13 / DQ-4).
    """
    found = payload_descriptions(raw).select(*KEY, F.col("value").alias("_new"), F.lit(True).alias("_raw"))
    j = silver.join(found, KEY, "left")
    own = F.col("source") == source
    hit = own & _missing(F.col("description")) & F.coalesce("_raw", F.lit(False))
    after = F.when(hit, F.col("_new")).otherwise(F.col("description"))
    stamps = {"updated_at": F.when(hit, F.current_timestamp()).otherwise(F.col("updated_at"))} if "updated_at" in silver.columns else {}
    new = j.withColumns({**stamps, "_after": after}).withColumn("description", F.col("_after")).select(*silver.columns)
    report = j.agg(
        F.count_if(own & _missing(F.col("description"))).alias("jobs_needing_descriptions"), F.count_if(hit).alias("updated"),
        F.count_if(own & ~_missing(after)).alias("jobs_with_descriptions"),
        F.count_if(own & _missing(after)).alias("jobs_still_missing"))
    return new, report


def dq_report(tables: dict[str, tuple[DataFrame, list[str], list[str]]], domain: dict | None = None) -> DataFrame:
    """DQ-1..3: per table — duplicate keys, NOT NULL violations, domain violations.

    ``tables``: name -> (frame, key columns, not-null columns). Each table is
    scanned once for its null / domain counts and once (pre-aggregated by key)
    for duplicates; the result is a small long-format report.
    """
    parts = []
    for name, (df, keys, not_null) in tables.items():
        dup = (df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > 1)
               .agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("violations"))
               .select(F.lit(name).alias("table_name"), F.lit("duplicate_key").alias("check_name"),
                       F.lit(",".join(keys)).alias("column_name"), "violations"))
        parts.append(dup)
        aggs = [F.count_if(F.col(c).isNull()).alias(f"nn_{c}") for c in not_null]
        for col_name, allowed in (domain or {}).get(name, {}).items():
            aggs.append(F.count_if(~F.col(col_name).isin(*allowed)).alias(f"dom_{col_name}"))
        wide = df.agg(*aggs)
        stack = [F.struct(F.lit("not_null").alias("check_name"), F.lit(c).alias("column_name"),
                          F.col(f"nn_{c}").alias("violations")) for c in not_null]
        for col_name in (domain or {}).get(name, {}):
            stack.append(F.struct(F.lit("domain").alias("check_name"), F.lit(col_name).alias("column_name"),
                                  F.col(f"dom_{col_name}").alias("violations")))
        parts.append(wide.select(F.explode(F.array(*stack)).alias("_c"))
                     .select(F.lit(name).alias("table_name"), "_c.check_name", "_c.column_name", "_c.violations"))
    return reduce(DataFrame.unionByName, parts)


def posting_trends(silver: DataFrame) -> DataFrame:
    """AGG-18: postings and average mid-salary per (first_seen, city, source)."""
    both = F.col("salary_min").isNotNull() & F.col("salary_max").isNotNull()
    return silver.groupBy(F.col("first_seen").alias("date"), "city", "source").agg(
        F.count("*").alias("job_count"),
        F.try_divide(F.sum(F.when(both, F.col("salary_min") + F.col("salary_max"))).cast("double"),
                     F.count_if(both) * 2).alias("avg_salary"))


def period_change(history: DataFrame, value: str, days: int, out: str) -> DataFrame:
    """WIN-5: change vs the same city ``days`` calendar days earlier (gap-safe RANGE frame)."""
    w = (Window.partitionBy("city", "state").orderBy(F.unix_date("run_date"))
         .rangeBetween(-days, -days))
    prev = F.first(value).over(w)
    return history.withColumn(f"{value}_{days}d_ago", prev).withColumn(
        out, F.round(F.try_divide((F.col(value) - prev) * 100.0, prev), 2))


def city_score_inputs(stats: DataFrame, housing: DataFrame | None) -> DataFrame:
    """AGG-19: inputs of the (unspecified) city score: volume, salary, remote share, rent."""
    base = stats.select("city", "state", "total_jobs", "avg_salary_max",
                        F.round(F.try_divide(F.col("remote_jobs") * 100.0, F.col("total_jobs")), 2)
                        .alias("remote_share"))
    if housing is None:
        return base.withColumn("rent_index", F.lit(None).cast("double"))
    from jobmart.operators.housing import rent_lookup

    rent = rent_lookup(housing)
    return (base.join(rent, (T.norm_key("city") == F.col("_rk")) & (F.col("state") == F.col("_rs")), "left")
            .select("city", "state", "total_jobs", "avg_salary_max", "remote_share",
                    F.col("metric_value_latest").alias("rent_index")))


def run_report(bronze: DataFrame, v1_bronze: DataFrame, call_log: DataFrame, run_date, source: str = "adzuna"):
    """AGG-13 / DQ-4: post-run verification counts for one run date, in one row.

    The three inputs are tagged and unioned, then counted in a single aggregate.
    """
    d = F.lit(str(run_date)).cast("date")
    tagged = (bronze.where((F.col("source") == source) & (F.col("last_seen") == d)).select(F.lit(1).alias("_k"))
              .unionByName(v1_bronze.where(F.to_date("fetched_at") == d).select(F.lit(2).alias("_k")))
              .unionByName(call_log.where(F.col("run_date") == d).select(F.lit(3).alias("_k"))))
    return tagged.agg(F.count_if(F.col("_k") == 1).alias("raw_jobs_seen"),
                      F.count_if(F.col("_k") == 2).alias("v1_rows_fetched"),
                      F.count_if(F.col("_k") == 3).alias("calls_recorded"))
