"""Landed search-API pages: one JSON line per fetched page.

A landed line is ``{run_date, city, role, page, body}`` where ``body`` is the
raw response text: ``{count, mean, results: [...]}`` for the first source,
``{data: [...]}`` for the second. Every landed page that parses and has records is
kept, whichever batch it comes in. The paging rule of a pull (SRC-2: pages before
the first that is missing, empty or unparsable, at most ``max_pages``) is a
feature of its own, applied only where ``max_pages`` is given, to whole pulls.

Records are kept as raw JSON (schema-on-read through ``VARIANT``), so fields
the parser does not know survive into the bronze payload.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LANDED_SCHEMA = "run_date date, city string, role string, page int, body string"
# Optional landing field: when the pull ran. Pulls run one after another, so it orders them.
LANDED_READ_SCHEMA = LANDED_SCHEMA + ", pulled_at timestamp"
PULL_KEY = ["run_date", "city", "role"]


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """SRC-1 / SRC-3: the landed page log (explicit schema, no inference pass)."""
    return spark.read.schema(LANDED_READ_SCHEMA).json(path)


FILES_SCHEMA = "value string, run_date date, city string, role string, page int"


def _from_files(df: DataFrame) -> DataFrame:
    return df.select("run_date", "city", "role", "page", F.col("value").alias("body"))


def read_landed_files(spark: SparkSession, path: str) -> DataFrame:
    """SRC-1 for raw response files: one file per fetched page, the pull keys in the path
    (``…/run_date=YYYY-MM-DD/city=…/role=…/page=N/<file>``), the file text as the body."""
    return _from_files(spark.read.schema(FILES_SCHEMA).option("basePath", path).text(path, wholetext=True))


def stream_landed_files(spark: SparkSession, path: str, **options) -> DataFrame:
    """The same layout as a stream (new response files become new rows)."""
    reader = spark.readStream.schema(FILES_SCHEMA).option("basePath", path)
    for k, v in options.items():
        reader = reader.option(k, v)
    return _from_files(reader.text(path, wholetext=True))


def page_records(landed: DataFrame, records_path: str = "$.results", max_pages: int | None = None,
                 source: str = "adzuna") -> DataFrame:
    """SRC-2 + ARR-3: records of the kept pages with pull metadata.

    Output: pull keys, pulled_at (when the pull ran, if landed), page, position,
    job_id, payload (raw record JSON), api_count / api_mean_salary (from page 1
    when it parsed), pages_fetched (the last page kept).
    With ``max_pages`` the per-pull state is a set of at most so many page numbers;
    without it, nothing is gathered but two page-1 values and a maximum.
    """
    if "pulled_at" not in landed.columns:
        landed = landed.withColumn("pulled_at", F.lit(None).cast("timestamp"))
    pages = landed.where(F.col("page") >= 1 if max_pages is None else F.col("page").between(1, max_pages))
    v = pages.withColumn("_v", F.try_parse_json("body"))
    recs = F.try_variant_get(F.col("_v"), records_path, "array<variant>")
    v = v.withColumn("_recs", recs)
    good = F.col("_v").isNotNull() & (F.coalesce(F.size("_recs"), F.lit(0)) > 0)
    pulls = v.groupBy(*PULL_KEY).agg(
        (F.max(F.when(good, F.col("page"))) if max_pages is None
         else F.array_sort(F.collect_set(F.when(good, F.col("page"))))).alias("_good"),
        F.min("pulled_at").alias("pulled_at"),
        F.max(F.when((F.col("page") == 1) & F.col("_v").isNotNull(),
                     F.coalesce(F.try_variant_get("_v", "$.count", "bigint"), F.lit(0)))).alias("api_count"),
        F.max(F.when((F.col("page") == 1) & F.col("_v").isNotNull(),
                     F.try_variant_get("_v", "$.mean", "double"))).alias("api_mean_salary"))
    first_gap = F.col("_good") + 1 if max_pages is None else F.array_min(F.filter(
        F.sequence(F.lit(1), F.lit(max_pages + 1)), lambda p: ~F.array_contains(F.col("_good"), p)))
    pulls = pulls.select(*PULL_KEY, "pulled_at", "api_count", "api_mean_salary", first_gap.alias("_cutoff"))
    kept = v.where(good).drop("pulled_at").join(pulls, PULL_KEY).where(F.col("page") < F.col("_cutoff"))
    out = kept.select(*PULL_KEY, "pulled_at", "page", "api_count", "api_mean_salary",
                      (F.col("_cutoff") - 1).alias("pages_fetched"),
                      F.posexplode("_recs").alias("position", "_rec"))
    id_path = "$.id" if records_path == "$.results" else "$.job_id"
    return out.select(*PULL_KEY, "pulled_at", "page", "position", F.lit(source).alias("source"),
                      F.try_variant_get("_rec", id_path, "string").alias("job_id"),
                      F.to_json("_rec").alias("payload"),
                      "api_count", "api_mean_salary", "pages_fetched")


def pull_summary(landed: DataFrame, records_path: str = "$.results", max_pages: int | None = None) -> DataFrame:
    """Per pull: pages kept, API metadata and the number of records retrieved."""
    recs = page_records(landed, records_path, max_pages)
    return recs.groupBy(*PULL_KEY).agg(
        F.max("pages_fetched").alias("pages_fetched"), F.max("api_count").alias("api_count"),
        F.max("api_mean_salary").alias("api_mean_salary"), F.count("*").alias("postings"))


def to_v1_rows(records: DataFrame) -> DataFrame:
    """PRJ-4: v1 bronze envelope ``{source, job_id, fetched_at, payload}`` per record."""
    return records.select("source", "job_id", F.col("run_date").alias("fetched_at"), "payload", "page", "position")
