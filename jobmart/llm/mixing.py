"""Mixing sources to target weights by systematic sampling.

Each source gets a target share of all words; a document's expected number of copies is its source's
target over its source's size. Documents of a source are laid out in a fixed order, the expected
copies are prefix-summed, one offset per source is added, and a document is emitted once for every
integer boundary its interval crosses. Since the expectation is the same for all documents of a source,
the prefix sum is the expectation times the document's rank, so only ranks are distributed work:

* order: size, then the id modulo ``BUCKETS``, then the id - by size, so that every stretch of sizes is
  sampled evenly and the taken words come near the target, not just the taken documents;
* the rank is built from three small windows (sizes of a source, buckets of a size, rows of a bucket), so a
  source or a group of equal sizes with a third of all rows never meets in one window.

The list of sources itself is a configuration-sized table (one weight each) and is ranked in one window.

Defined results: null text has size 0, null source is the last source, null doc_id sorts first inside its
size; repeated rows are separate documents; an empty table gives an empty table. Reruns agree: the offset
is derived from the source's name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobmart.llm.common import WORD, content_hash, staged, text_or_empty

WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3.0
BUCKETS = 1024


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, row hash, size in words); the only pass over the texts."""
    return docs.select("doc_id", "source", content_hash(docs).alias("row"),
                       F.size(F.regexp_extract_all(text_or_empty(), F.lit(f"({WORD})"), F.lit(1))).cast("long").alias("size"))


def targets(sizes: DataFrame, weights=WEIGHTS, cap: float = CAP) -> DataFrame:
    """One row per source: size, target words, expected copies and offset.

    Weights repeat over the sources in code-point order, null last. A target stops at ``cap`` times the
    source's size and the rest is shared again by weight: with sources sorted by cap/weight, the capped ones
    are a prefix, found where the common level of the others first stays below the next cap/weight.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.array(*[F.lit(float(x)) for x in weights])
    s = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
         .withColumn("weight", F.get(w, (F.row_number().over(by_name) - 1) % len(weights))))
    top = F.lit(cap) * F.col("source_size")
    order = Window.orderBy(top / F.col("weight"), F.col("source").asc_nulls_last())
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumns({"_top": top,
                       "_left": F.sum("source_size").over(every) - F.coalesce(F.sum(top).over(before), F.lit(0.0)),
                       "_weight": F.sum("weight").over(rest)})
    s = s.withColumn("_level", F.col("_left") / F.col("_weight"))
    s = s.withColumn("_free", F.col("_level") * F.col("weight") <= F.col("_top"))
    level = F.min(F.when(F.col("_free"), F.struct(F.col("_top") / F.col("weight"), F.col("_level").alias("level")))).over(every)["level"]
    target = F.when(F.col("_free"), F.coalesce(level, F.lit(0.0)) * F.col("weight")).otherwise(F.col("_top"))
    return s.select("source", "source_size", F.least(target, F.col("_top")).alias("target")).withColumns({
        "rate": F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)),
        "offset": offset()})


def offset() -> Column:
    """A number in [0, 1) drawn from the source's name: the same on every run."""
    return F.conv(F.substring(F.md5(F.concat(F.lit("mix:"), F.coalesce("source", F.lit("\u0000")))), 1, 12), 16, 10).cast("double") / F.lit(float(16 ** 12))


def ranks(sizes: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``sizes`` plus ``rank``: the position (from 0) in the source by size, id bucket and id."""
    d = sizes.withColumn("_b", F.coalesce(F.pmod(F.col("doc_id"), F.lit(buckets)), F.lit(-1)))
    small = d.groupBy("source", "size", "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = lambda *by: Window.partitionBy(*by)
    sizes_of = small.groupBy("source", "size").agg(F.sum("_n").alias("_n"))
    ahead = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = sizes_of.select(F.col("source").alias("_s1"), F.col("size").alias("_z1"), ahead(before("source").orderBy("size")).alias("_a"))
    second = small.select("source", "size", "_b", ahead(before("source", "size").orderBy("_b")).alias("_c"))
    start = (second.join(first, F.col("source").eqNullSafe(F.col("_s1")) & (F.col("size") == F.col("_z1")))
             .select(F.col("source").alias("_s2"), F.col("size").alias("_z2"), F.col("_b").alias("_b2"), (F.col("_a") + F.col("_c")).alias("_start")))
    inner = F.row_number().over(Window.partitionBy("source", "size", "_b").orderBy("doc_id", "row")) - 1
    return (d.withColumn("_i", inner)
            .join(start, F.col("source").eqNullSafe(F.col("_s2")) & (F.col("size") == F.col("_z2")) & (F.col("_b") == F.col("_b2")))
            .select("doc_id", "source", "row", "size", (F.col("_start") + F.col("_i")).alias("rank")))


def copies_table(docs: DataFrame, weights=WEIGHTS, cap: float = CAP) -> DataFrame:
    """One row per document: size, its source's size and target, and the copies the mix takes."""
    sizes = staged(sized(docs), "sizes")
    t = staged(targets(sizes, weights, cap), "targets")
    per = t.select(F.col("source").alias("_s"), "source_size", "target", "rate", "offset")
    r = ranks(sizes).join(per, F.col("source").eqNullSafe(F.col("_s")))
    crossed = F.floor(F.col("offset") + F.col("rate") * (F.col("rank") + 1)) - F.floor(F.col("offset") + F.col("rate") * F.col("rank"))
    return r.select("doc_id", "source", "row", "size", "source_size", "target", F.least(crossed, F.floor(F.lit(cap))).cast("long").alias("copies"))


def mix_report(docs: DataFrame, weights=WEIGHTS, cap: float = CAP) -> DataFrame:
    c = copies_table(docs, weights, cap)
    return c.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mix(docs: DataFrame, weights=WEIGHTS, cap: float = CAP) -> DataFrame:
    """The mixed corpus: every document repeated as often as it was taken, with the columns of ``docs``.

    Rows are matched to their copies by doc_id and content. Identical rows are interchangeable: one of them stands for
    all and is repeated as often as all of them were taken.
    """
    c = copies_table(docs, weights, cap)
    shared = staged(c.groupBy("doc_id", "row").agg(F.sum("copies").alias("k"), F.count(F.lit(1)).alias("n")).where("k > 0")
                    .withColumnsRenamed({"doc_id": "id"}), "copies")
    d = docs.select(F.struct("*").alias("d"), F.col("doc_id").alias("of_id"), content_hash(docs).alias("of"))
    same = F.col("of_id").eqNullSafe(F.col("id")) & (F.col("of") == F.col("row"))
    one, many = d.join(shared.where("n = 1"), same), d.join(shared.where("n > 1"), same).dropDuplicates(["of_id", "of"])
    return one.unionByName(many).select("d", F.explode(F.sequence(F.lit(1).cast("long"), F.col("k")))).select("d.*")
