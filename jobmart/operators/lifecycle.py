"""Bronze sighting lifecycle: first seen / last seen / times seen with keyed upserts.

Semantics (one batch = the postings landed for ``run_date``):

* unseen key  -> insert with first = last = run_date, times = 1;
* ``last_seen < run_date`` -> last = run_date, times + 1, payload replaced;
* otherwise   -> unchanged (a replayed or older day is a no-op);
* duplicates inside a batch: the first arrival wins.

A multi-day batch is folded exactly as if the days were applied one after
another, so backfills and replays are one join instead of a loop of joins.

Winners before payloads: which arrival wins is decided on fixed-width columns alone (key, day, arrival number) by
hash aggregates with a partial step, so a job id carrying a third of all sightings is collapsed per task before the
shuffle and no payload is sorted or buffered; the winners' payloads are then fetched by one join. Keys are not null.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = ["source", "job_id"]
TARGET_COLS = ["source", "job_id", "first_seen", "last_seen", "times_seen", "payload"]


def empty_target(spark) -> DataFrame:
    return spark.createDataFrame([], "source string, job_id string, first_seen date, last_seen date, "
                                     "times_seen int, payload string")


def _micros(col: str, kind: str) -> Column:
    if kind == "timestamp":
        return F.unix_micros(col)
    # A time without zone, counted without the session's zone.
    minutes = F.unix_date(F.col(col).cast("date")).cast("bigint") * 1440 + F.hour(col) * 60 + F.minute(col)
    return minutes * 60_000_000 + (F.date_part(F.lit("SECOND"), F.col(col)) * 1_000_000).cast("bigint")


def arrival(df: DataFrame, order: list[str]) -> Column:
    """The order columns as one value to compare.

    (timestamp, bigint) becomes a number, which a hash aggregate can hold, and one column (not null) stays itself;
    anything else becomes a struct, which makes the aggregate sort (its rows still are narrow). Nulls come first.
    """
    if len(order) == 1:
        return F.col(order[0])
    kinds = [df.schema[c].dataType.typeName() for c in order]
    if len(kinds) != 2 or kinds[0] not in ("timestamp", "timestamp_ntz") or kinds[1] != "long":
        return F.struct(*[F.col(c) for c in order])
    whole = lambda c, none: F.coalesce(c, F.lit(none)).cast("decimal(20,0)")
    micros, number = whole(_micros(order[0], kinds[0]), -(2 ** 62)), whole(F.col(order[1]), -(2 ** 63))
    return micros * F.lit(Decimal(2 ** 64)) + (number + F.lit(Decimal(2 ** 63)))


def fetch(rows: DataFrame, winners: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """The winners with the other columns of their rows; of rows that agree in all of ``on``, one."""
    first = F.row_number().over(Window.partitionBy(*on[:-1]).orderBy(on[-1]))
    return winners.join(rows, on, how).withColumn("_n", first).where("_n = 1").drop("_n")


def _per_key(batch: DataFrame, keys: list[str], order: list[str], cols: list[str], pick) -> DataFrame:
    rows = batch.select(*keys, arrival(batch, order).alias("_a"), *[c for c in cols if c not in keys])
    winners = rows.groupBy(*keys).agg(pick("_a").alias("_a"))
    return fetch(rows, winners, [*keys, "_a"]).select(*keys, *[c for c in cols if c not in keys])


def first_per_key(batch: DataFrame, keys: list[str], order: list[str], cols: list[str]) -> DataFrame:
    """WIN-4 / SNK-3 batch side: the earliest arrival per key."""
    return _per_key(batch, keys, order, cols, F.min)


def last_per_key(batch: DataFrame, keys: list[str], order: list[str], cols: list[str]) -> DataFrame:
    return _per_key(batch, keys, order, cols, F.max)


def _day_winners(batch: DataFrame, order: list[str], last_wins: bool) -> tuple[DataFrame, DataFrame]:
    """The batch with its arrival numbers, and one narrow row per (key, run_date): the winning arrival."""
    rows = batch.select(*KEY, "run_date", arrival(batch, order).alias("_a"), "payload")
    return rows, rows.groupBy(*KEY, "run_date").agg((F.max if last_wins else F.min)("_a").alias("_a"))


def fold_sightings(sightings: DataFrame, order: list[str] = ("ts", "event_id"), last_wins: bool = False) -> DataFrame:
    """AGG-16: the whole lifecycle table from a sighting log in one pass.

    Equals applying :func:`upsert_sightings` day by day to an empty table.
    """
    rows, days = _day_winners(sightings, list(order), last_wins)
    table = days.groupBy(*KEY).agg(
        F.min("run_date").alias("first_seen"),
        F.max("run_date").alias("last_seen"),
        F.count("*").cast("int").alias("times_seen"),
        F.max_by("_a", "run_date").alias("_a"),
    )
    rows = rows.withColumnRenamed("run_date", "last_seen")
    return fetch(rows, table, [*KEY, "last_seen", "_a"]).select(*TARGET_COLS)


def upsert_sightings(target: DataFrame, batch: DataFrame, order: list[str] = ("ts", "event_id"),
                     refresh_payload: bool = False) -> DataFrame:
    """SNK-4 (and SNK-5 with ``refresh_payload``): merge a batch into the lifecycle table.

    ``batch`` has KEY, ``run_date``, ``payload`` and the arrival-order columns;
    it may span several days. Returns the new table plus a boolean
    ``changed`` (inserted or advanced) — its count is the run's ``n_new``.

    With ``refresh_payload`` the payload of every batch key is replaced by the
    last arrival of the key's latest batch day, even when that day is not newer
    (same-day re-pull), and the day counters still move only for newer days.
    """
    rows, days = _day_winners(batch, list(order), refresh_payload)
    t_last = target.select(*KEY, F.col("last_seen").alias("_t_last"))
    # Only days newer than what the table holds count as sightings.
    d = days.join(t_last, KEY, "left")
    newer = F.col("_t_last").isNull() | (F.col("run_date") > F.col("_t_last"))
    # The day whose winner gives the payload: the last newer one, or with refresh the last one.
    day = F.col("run_date") if refresh_payload else F.when(newer, F.col("run_date"))
    per_key = d.groupBy(*KEY).agg(
        F.min(F.when(newer, F.col("run_date"))).alias("_b_first"),
        F.max(F.when(newer, F.col("run_date"))).alias("_b_last"),
        F.count_if(newer).cast("int").alias("_b_days"),
        F.max(day).alias("run_date"),
        F.max_by("_a", day).alias("_a"),
    )
    won = fetch(rows, per_key.where(F.col("run_date").isNotNull()), [*KEY, "run_date", "_a"])
    won = won.drop("run_date", "_a").withColumnRenamed("payload", "_b_payload")
    m = target.join(won, KEY, "full")
    advanced = F.coalesce(F.col("_b_days") > 0, F.lit(False))
    fetched = F.col("_b_days").isNotNull()
    return m.select(
        *KEY,
        F.coalesce(F.col("first_seen"), F.col("_b_first")).alias("first_seen"),
        F.when(advanced, F.col("_b_last")).otherwise(F.col("last_seen")).alias("last_seen"),
        (F.coalesce(F.col("times_seen"), F.lit(0)) + F.coalesce(F.col("_b_days"), F.lit(0))).cast("int").alias("times_seen"),
        F.when(advanced | (fetched & F.col("_b_payload").isNotNull()), F.col("_b_payload"))
        .otherwise(F.col("payload")).alias("payload"),
        advanced.alias("changed"),
    )


def seen_on(target: DataFrame, source: str, run_date) -> DataFrame:
    """FLT-2: ids already seen on ``run_date``."""
    return target.where((F.col("source") == source) & (F.col("last_seen") == F.lit(str(run_date)).cast("date"))).select("job_id")


def filter_new(batch: DataFrame, target: DataFrame, source: str, run_date) -> DataFrame:
    """JOIN-4 / SET-2: batch minus ids already processed today (anti-join)."""
    return batch.join(seen_on(target, source, run_date), "job_id", "left_anti")


# --- v1 bronze: insert-ignore on (job_id, fetched_at) -------------------------------------

V1_KEY = ["job_id", "fetched_at"]


def insert_ignore(target: DataFrame, batch: DataFrame, order: list[str] = ("ts", "event_id")) -> DataFrame:
    """SNK-3: ``INSERT … ON CONFLICT (job_id, fetched_at) DO NOTHING``.

    The batch is deduplicated by arrival (first wins), then rows whose key is
    already present are dropped with a left-anti join and the rest appended.
    """
    first = first_per_key(batch, V1_KEY, list(order), ["source", "payload"])
    new = first.join(target.select(*V1_KEY), V1_KEY, "left_anti")
    return target.unionByName(new.select(*target.columns))


def latest_version(v1_bronze: DataFrame) -> DataFrame:
    """WIN-1: ``DISTINCT ON (job_id) … ORDER BY fetched_at DESC`` as a partial aggregate."""
    return last_per_key(v1_bronze, ["job_id"], ["fetched_at"], ["source", "payload", "fetched_at"])


def not_in_silver(latest: DataFrame, silver: DataFrame, source: str) -> DataFrame:
    """JOIN-3: ``LEFT JOIN silver … WHERE s.job_id IS NULL`` as a left-anti join."""
    return latest.join(silver.where(F.col("source") == source).select("job_id"), "job_id", "left_anti")


def restamp_stale(df: DataFrame, ts_col: str, as_of) -> DataFrame:
    """FLT-6 / DAT-7: ``SET processed_at = now WHERE processed_at < now - 1 hour``."""
    now = F.lit(str(as_of)).cast(df.schema[ts_col].dataType)
    return df.withColumn(ts_col, F.when(F.col(ts_col) < now - F.expr("INTERVAL 1 HOUR"), now).otherwise(F.col(ts_col)))
