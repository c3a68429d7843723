"""Housing metrics: wide monthly CSVs -> latest value / long history -> job joins.

The wide file has one row per region and one column per month (``YYYY-MM-DD``).
Which column is the latest is decided from the schema alone (driver-side
metadata, no data collected). Joins to postings use the case-insensitive
(city, state code) key; the housing side is one row per region, so it is
broadcast only after its row count is checked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmart import constants as K
from jobmart.functions import text as T
from jobmart.sources.tables import checked_broadcast

HOUSING_KEY = ["data_source", "metric_type", "region_id", "date_recorded"]


def read_wide_csv(spark: SparkSession, path: str, infer: bool = True) -> DataFrame:
    """SRC-5: the CSV as-is, columns from the header (schema inferred when asked)."""
    return spark.read.csv(path, header=True, inferSchema=infer)


def date_columns(wide: DataFrame) -> list[str]:
    """PRJ-6: the month columns (``'-' in name`` and 10 characters long)."""
    return [c for c in wide.columns if "-" in c and len(c) == 10]


def latest_metric(wide: DataFrame, data_source: str, metric_type: str) -> DataFrame:
    """PIP-6 / PRJ-5 / FLT-1: metro rows with the value of the latest month column."""
    latest = max(date_columns(wide))
    return (wide.where(F.col("RegionType") == K.HOUSING_REGION_TYPE)
            .select(F.col("RegionID").cast("int").alias("region_id"),
                    F.col("SizeRank").cast("int").alias("size_rank"),
                    F.col("RegionName").alias("region_name"),
                    F.col("StateName").alias("state_code"),
                    F.lit(None).cast("string").alias("cbsa_code"),
                    F.lit(data_source).alias("data_source"),
                    F.lit(metric_type).alias("metric_type"),
                    F.col(f"`{latest}`").cast("double").alias("metric_value_latest"),
                    F.lit(latest).alias("date_recorded")))


def long_history(wide: DataFrame, data_source: str, metric_type: str) -> DataFrame:
    """PRJ-7: every (region, month) measurement — ``unpivot`` of the month columns."""
    months = date_columns(wide)
    ids = ["RegionID", "RegionName", "StateName"]
    typed = wide.where(F.col("RegionType") == K.HOUSING_REGION_TYPE).select(
        *ids, *[F.col(f"`{m}`").cast("double").alias(m) for m in months])
    long = typed.unpivot(ids, [F.col(f"`{m}`") for m in months], "date_recorded", "metric_value")
    return (long.where(F.col("metric_value").isNotNull())
            .select(F.col("RegionID").cast("int").alias("region_id"), F.col("RegionName").alias("region_name"),
                    F.col("StateName").alias("state_code"), F.lit(data_source).alias("data_source"),
                    F.lit(metric_type).alias("metric_type"), "date_recorded", "metric_value"))


def replace_metrics(target: DataFrame, new: DataFrame) -> DataFrame:
    """SNK-2 made idempotent: rows of ``new`` replace same-key rows of ``target``."""
    return target.join(new.select(*HOUSING_KEY), HOUSING_KEY, "left_anti").unionByName(new)


def region_key(region_name, strip_state_suffix: bool = False):
    """Join key of a housing region: lower(trim(name)); optionally drop a trailing ", ST"
    (metro names such as "Chicago, IL" — off by default, as the source data format is unknown)."""
    name = F.col(region_name) if isinstance(region_name, str) else region_name
    if strip_state_suffix:
        name = F.regexp_replace(name, r",\s*[A-Za-z]{2}\s*$", "")
    return T.norm_key(name)


def rent_lookup(housing: DataFrame, strip_state_suffix: bool = False) -> DataFrame:
    """One row per (lower(trim(region_name)), state_code): smallest size rank wins."""
    return (housing.groupBy(region_key("region_name", strip_state_suffix).alias("_rk"), F.col("state_code").alias("_rs"))
            .agg(F.min_by(F.struct("region_name", "cbsa_code", "metric_value_latest", "date_recorded"),
                          F.col("size_rank")).alias("_h"))
            .select("_rk", "_rs", "_h.*"))


def city_mapping(silver: DataFrame, housing: DataFrame, strip_state_suffix: bool = False) -> DataFrame:
    """JOIN-6 / AGG-15 / STR-18: DISTINCT active (city, state) x matching housing regions."""
    key = region_key("region_name", True) if strip_state_suffix else F.lower("region_name")
    h = checked_broadcast(housing.select(key.alias("_rk"), F.col("state_code").alias("_rs"),
                                         "region_name", "cbsa_code"))
    j = silver.where(F.col("is_active")).select("city", "state", "state_code").distinct()
    return (j.join(h, (F.lower(j.city) == h._rk) & (j.state_code == h._rs), "left")
            .select("city", "state", "state_code", "region_name", "cbsa_code").distinct())


def affordability(snapshot: DataFrame) -> DataFrame:
    """JOIN-13 / NUM-5 / NUM-7: rent vs salary per city from a rent-joined snapshot."""
    return snapshot.select(
        "city", "state", "avg_salary", "zori_latest", "zori_date", "salary_to_rent_ratio",
        (F.col("zori_latest") * 12 <= F.col("avg_salary") * K.RENT_SHARE_OF_INCOME).alias("affordable"))


def cbsa_codes(silver: DataFrame, lookup: DataFrame) -> DataFrame:
    """JOIN-11: ``UPDATE … FROM cbsa_lookup`` on lower(trim()) state and city.

    The lookup is made unique per key first (smallest code), so each posting
    gets at most one code; it is broadcast only below the checked row bound.
    """
    lk = (lookup.groupBy(T.norm_key("state_code").alias("_ls"), T.norm_key("primary_city").alias("_lc"))
          .agg(F.min("cbsa_code").alias("_code")))
    j = silver.join(checked_broadcast(lk), (T.norm_key("state_code") == F.col("_ls"))
                    & (T.norm_key("city") == F.col("_lc")), "left")
    return j.select("source", "job_id", F.col("_code").alias("cbsa_code"))
