"""Exact grouped median (``PERCENTILE_CONT(0.5)``) without one-task groups.

The built-in ``percentile`` keeps a value→count map per group and merges it in
a single task, so a hot group (a third of all rows) with many distinct values
becomes one huge task. Here the exact answer is found with two passes over
the data (their small results are written to the shared folder once) and
small follow-up steps:

1. per (group, metric): ``n`` and an approximate band ``[lo, hi]`` around the
   median from ``percentile_approx`` (a mergeable sketch with a deterministic
   rank error of ``n / accuracy``);
2. every value is tagged below / inside / above the band, and in-band values
   get an equal-width sub-bucket ``b`` of the band (monotone in the value).
   Rows are counted per (group, metric, tier, b, value): partial aggregation
   collapses duplicates, and the shuffle spreads over distinct values, not
   over groups;
3. summing those counts per (tier, b) gives a histogram of at most
   ``SUB_BUCKETS + 2`` rows per group; a running count over it finds the
   sub-bucket and the offset of each middle rank;
4. only the (at most two) target sub-buckets are ranked value by value, so
   the largest window is one sub-bucket (≈ 6·n / (accuracy · SUB_BUCKETS)
   distinct values), not the group.

A group whose middle ranks fall outside its band is searched from its whole range (:func:`_searched`): every pass
cuts the span that holds the rank into ``SUB_BUCKETS`` slots, counts them in one aggregate and goes on in the slot of
the rank, until a span is one value. No window ever holds more than a group's slots, whatever the group's size.

:func:`running_medians` does the same for a multiset that changes from day to day: counts of slots and days take the
place of counts of slots, so its work follows the changes and the days, not the members of each day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobmart.sources.tables import checked_broadcast, write_table

ACCURACY = 10_000
SUB_BUCKETS = 4096
# Slots a level in which the running medians count: a row for each slot, day and group.
DAY_SLOTS = 256
_BAND = 3.0 / ACCURACY


def _alias_keys(keys: list[str]) -> list:
    return [F.col(k).alias(f"_b{i}") for i, k in enumerate(keys)]


def _on(keys: list[str]):
    return [F.col(k).eqNullSafe(F.col(f"_b{i}")) for i, k in enumerate(keys)]


def _middle_ranks():
    return F.floor((F.col("_n") - 1) / 2), F.ceil((F.col("_n") - 1) / 2)


def _slot(n: int):
    """The slot of ``_v`` among ``n`` equal parts of [_lo, _hi]; never decreasing in the value, 0 for _lo, n - 1 for _hi."""
    v, lo, hi = F.col("_v"), F.col("_lo"), F.col("_hi")
    far = hi - lo == float("inf")  # halves, where the span itself is beyond a double
    share = F.when(far, (v / 2 - lo / 2) / (hi / 2 - lo / 2)).otherwise((v - lo) / (hi - lo))
    return F.least(F.floor(share * n), F.lit(n - 1)).cast("int")


def _searched(rows: DataFrame, gk: list[str]) -> DataFrame:
    """Exact medians by search: one pass over the rows a level, one written row per group between them."""
    spans = rows.groupBy(*gk).agg(F.count("*").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    spans = write_table(spans.withColumn("_r", F.floor((F.col("_n") - 1) / 2)).select(*_alias_keys(gk), "_n", "_r", "_lo", "_hi"), "median_spans")
    names = [c for c in spans.columns if c.startswith("_b")]
    while not spans.where("_lo < _hi").isEmpty():
        open_spans = checked_broadcast(spans.where("_lo < _hi"))
        inside = rows.join(open_spans, _on(gk)).where((F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi")))
        slots = inside.groupBy(*names, "_n", "_r", _slot(SUB_BUCKETS).alias("_s")).agg(F.count("*").alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        w = Window.partitionBy(*names).orderBy("_s").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        at = slots.withColumn("_start", F.sum("_c").over(w) - F.col("_c"))
        at = at.where((F.col("_start") <= F.col("_r")) & (F.col("_r") < F.col("_start") + F.col("_c")))
        deeper = at.select(*names, "_n", (F.col("_r") - F.col("_start")).alias("_r"), "_lo", "_hi")
        spans = write_table(deeper.unionByName(spans.where("_lo = _hi")), "median_spans")
    # The upper middle is the same value, or the next one above it.
    lower = F.col("_lo")
    both = rows.join(checked_broadcast(spans), _on(gk)).groupBy(*gk, "_n", "_lo").agg(
        F.count_if(F.col("_v") <= lower).alias("_le"), F.min(F.when(F.col("_v") > lower, F.col("_v"))).alias("_next"))
    upper = F.when(F.col("_le") > F.ceil((F.col("_n") - 1) / 2), lower).otherwise(F.col("_next"))
    return both.select(*gk, (lower + (upper - lower) * 0.5).alias("_med"))


def running_medians(members: DataFrame, keys: list[str], columns: dict[str, str], first, last) -> DataFrame:
    """The exact medians of each group on every day from ``first`` to ``last`` (dates as columns).

    ``members``: rows with ``_from`` (the day a row joins its group) and ``_until`` (the day it leaves, NULL: never).
    Returns keys, ``run_date`` and a column for each of ``columns``, for the days on which a group has a value.
    """
    g = F.struct(*keys).alias("_g")  # one key that is never null
    rows = members.where((F.col("_from") <= last) & (F.col("_until").isNull() | (F.col("_until") > first)))
    come = F.struct(F.greatest("_from", first).alias("day"), F.lit(1).cast("bigint").alias("d"))
    leave = F.when(F.col("_until") <= last, F.struct(F.col("_until").alias("day"), F.lit(-1).cast("bigint").alias("d")))
    moves = rows.select(g, *columns.values(), F.explode(F.filter(F.array(come, leave), lambda x: x.isNotNull())).alias("_x"))
    values = F.array(*[F.struct(F.lit(i).alias("_m"), F.col(c).cast("double").alias("_v")) for i, c in enumerate(columns.values())])
    moves = moves.select("_g", F.explode(values).alias("_mv"), F.col("_x.day").alias("_day"), F.col("_x.d").alias("_d"))
    moves = moves.select("_g", "_mv._m", "_mv._v", "_day", "_d").where(F.col("_v").isNotNull())
    # How often each value comes and goes on a day.
    moves = write_table(moves.groupBy("_g", "_m", "_v", "_day").agg(F.sum("_d").alias("_d")), "median_moves")

    def standing(changes: DataFrame, by: list[str]) -> DataFrame:
        """The sum of the changes so far, for every day of the range: a row stands until the next change."""
        w = Window.partitionBy(*by).orderBy("_day")
        so_far = changes.withColumns({"_c": F.sum("_d").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
                                      "_next": F.coalesce(F.lead("_day").over(w), F.date_add(last, 1))})
        return so_far.where("_c > 0").select(*by, "_c", F.explode(F.sequence(F.col("_day"), F.date_sub("_next", 1))).alias("_day"))

    sizes = standing(moves.groupBy("_g", "_m", "_day").agg(F.sum("_d").alias("_d")), ["_g", "_m"])
    spans = moves.groupBy("_g", "_m").agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    asks = sizes.join(spans, ["_g", "_m"]).select("_g", "_m", "_day", F.posexplode(F.array(
        F.floor((F.col("_c") - 1) / 2), F.ceil((F.col("_c") - 1) / 2))).alias("_w", "_r"), "_lo", "_hi")
    asks = write_table(asks, "median_asks")
    span = ["_g", "_m", "_lo", "_hi"]
    while not asks.where("_lo < _hi").isEmpty():
        looked = asks.where("_lo < _hi").select(*span).distinct()
        inside = moves.join(looked, ["_g", "_m"]).where((F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi")))
        cells = write_table(inside.groupBy(*span, _slot(DAY_SLOTS).alias("_s"), "_day").agg(
            F.sum("_d").alias("_d"), F.min("_v").alias("_slo"), F.max("_v").alias("_shi")), "median_cells")
        bounds = cells.groupBy(*span, "_s").agg(F.min("_slo").alias("_slo"), F.max("_shi").alias("_shi"))
        counts = standing(cells.select(*span, "_s", "_day", "_d"), [*span, "_s"])
        w = Window.partitionBy("_g", "_m", "_w", "_day").orderBy("_s").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        at = asks.where("_lo < _hi").join(counts, [*span, "_day"]).withColumn("_start", F.sum("_c").over(w) - F.col("_c"))
        at = at.where((F.col("_start") <= F.col("_r")) & (F.col("_r") < F.col("_start") + F.col("_c"))).join(bounds, [*span, "_s"])
        deeper = at.select("_g", "_m", "_day", "_w", (F.col("_r") - F.col("_start")).alias("_r"), F.col("_slo").alias("_lo"), F.col("_shi").alias("_hi"))
        asks = write_table(deeper.unionByName(asks.where("_lo = _hi").select(*deeper.columns)), "median_asks")
    v1, v2 = (F.max(F.when(F.col("_w") == i, F.col("_lo"))) for i in (0, 1))
    found = asks.groupBy("_g", "_m", "_day").agg(v1.alias("_v1"), v2.alias("_v2"))
    median = F.col("_v1") + (F.col("_v2") - F.col("_v1")) * 0.5
    return found.groupBy("_g", "_day").agg(*[F.max(F.when(F.col("_m") == i, median)).alias(name) for i, name in enumerate(columns)]).select(
        "_g.*", F.col("_day").alias("run_date"), *columns)


def grouped_median(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """One row per group with a non-NULL value: keys + exact median ``out`` (double)."""
    res = grouped_medians(df, keys, {out: value})
    return res.where(F.col(out).isNotNull())


def grouped_medians(df: DataFrame, keys: list[str], columns: dict[str, str]) -> DataFrame:
    """Exact medians of several columns per group, two passes over ``df``.

    ``columns`` maps output name -> input column. The columns are stacked into
    (metric, value) rows so the band and the tagging pass serve all of them.
    Returns one row per group that has a non-NULL value in any column.
    """
    metrics = list(columns)
    stacked = df.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(i).alias("_m"), F.col(c).cast("double").alias("_v")) for i, c in enumerate(columns.values())
    ])).alias("_mv")).select(*keys, "_mv._m", "_mv._v").where(F.col("_v").isNotNull())
    gk = keys + ["_m"]

    # 1. band per (group, metric)
    band = stacked.groupBy(*gk).agg(
        F.count("*").alias("_n"),
        F.percentile_approx("_v", [max(0.0, 0.5 - _BAND), min(1.0, 0.5 + _BAND)], ACCURACY).alias("_q"))
    # One row per (group, metric), written once: it is broadcast behind a check of its size, so the
    # rows themselves are tagged where they are read; beyond the check the join is planned by AQE.
    band = checked_broadcast(write_table(
        band.select(*_alias_keys(gk), "_n", F.col("_q")[0].alias("_lo"), F.col("_q")[1].alias("_hi")), "median_band"))

    # 2. tier + sub-bucket per row, counted per distinct value
    v, lo, hi = F.col("_v"), F.col("_lo"), F.col("_hi")
    tier = F.when(v < lo, 0).when(v > hi, 2).otherwise(1)
    sub = F.when(hi > lo, F.least(F.floor((v - lo) / (hi - lo) * SUB_BUCKETS), F.lit(SUB_BUCKETS - 1))) \
        .otherwise(F.lit(0))
    tagged = stacked.join(band, _on(gk)).select(
        *gk, "_n", tier.alias("_tier"),
        F.when(tier == 1, sub).alias("_sb"), F.when(tier == 1, v).alias("_v"))
    # Distinct in-band values (+ one row per group for each out-of-band tier): ~6·n/accuracy + 2
    # rows per group. Written once: the histogram and the final ranking both read it, so the
    # data is scanned only by the band pass and this tagging pass.
    counts = write_table(tagged.groupBy(*gk, "_n", "_tier", "_sb", "_v").agg(F.count("*").alias("_c")),
                         "median_counts")

    # 3. histogram over (tier, sub-bucket): <= SUB_BUCKETS + 2 rows per group
    hist = counts.groupBy(*gk, "_n", "_tier", "_sb").agg(F.sum("_c").alias("_hc"))
    wh = Window.partitionBy(*gk).orderBy("_tier", "_sb").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hist = hist.withColumn("_hend", F.sum("_hc").over(wh)).withColumn("_hstart", F.col("_hend") - F.col("_hc"))
    r1, r2 = _middle_ranks()
    hit1 = (F.col("_hstart") <= r1) & (r1 < F.col("_hend"))
    hit2 = (F.col("_hstart") <= r2) & (r2 < F.col("_hend"))
    targets = hist.groupBy(*gk).agg(
        F.max(F.when(hit1, F.col("_tier"))).alias("_t1"), F.max(F.when(hit2, F.col("_tier"))).alias("_t2"),
        F.max(F.when(hit1, F.col("_sb"))).alias("_sb1"), F.max(F.when(hit2, F.col("_sb"))).alias("_sb2"),
        F.max(F.when(hit1, r1 - F.col("_hstart"))).alias("_o1"),
        F.max(F.when(hit2, r2 - F.col("_hstart"))).alias("_o2"))
    # One row per (group, metric): small; written once so the check and the ranking reuse it.
    targets = write_table(targets.withColumn("_ok", (F.col("_t1") == 1) & (F.col("_t2") == 1)), "median_targets")

    # 4. rank values inside the target sub-buckets only
    good = targets.where("_ok").select(*_alias_keys(gk), "_sb1", "_sb2", "_o1", "_o2")
    inband = counts.where(F.col("_tier") == 1).join(good, _on(gk))
    inband = inband.where((F.col("_sb") == F.col("_sb1")) | (F.col("_sb") == F.col("_sb2")))
    wv = Window.partitionBy(*gk, "_sb").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = inband.withColumn("_end", F.sum("_c").over(wv)).withColumn("_start", F.col("_end") - F.col("_c"))

    def at(sb: str, off: str):
        return (F.col("_sb") == F.col(sb)) & (F.col("_start") <= F.col(off)) & (F.col(off) < F.col("_end"))

    picked = ranked.groupBy(*gk).agg(F.max(F.when(at("_sb1", "_o1"), F.col("_v"))).alias("_v1"),
                                     F.max(F.when(at("_sb2", "_o2"), F.col("_v"))).alias("_v2"))
    result = picked.select(*gk, (F.col("_v1") + (F.col("_v2") - F.col("_v1")) * 0.5).alias("_med"))

    bad = targets.where(~F.col("_ok")).select(*_alias_keys(gk))
    if not bad.isEmpty():
        result = result.unionByName(_searched(stacked.join(bad, _on(gk), "left_semi"), gk))
    return result.groupBy(*keys).agg(*[
        F.max(F.when(F.col("_m") == i, F.col("_med"))).alias(name) for i, name in enumerate(metrics)])
