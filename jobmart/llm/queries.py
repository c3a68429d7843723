"""The registered queries: each applies its operator to its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmart.llm import ann, centroids, chat, html, merkle, mixing, packing, pii, quality, repeats, simhash, warc, zstd_quality
from jobmart.llm.common import read, staged


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_public(read(spark, sf_dir, "documents"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(read(spark, sf_dir, "documents"))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digests(chat.with_probe(read(spark, sf_dir, "conversations")))


def op4_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.revisits_report(read(spark, sf_dir, "pages"))


def op5_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(read(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(read(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(read(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(read(spark, sf_dir, "embeddings"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(read(spark, sf_dir, "pages"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.cluster(read(spark, sf_dir, "embeddings"))
    members = staged(found.members, "centroid-members")
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    # One row for each of the few clusters.
    sums = {r["cluster"]: r["total"] for r in members.groupBy("cluster").agg(total.alias("total")).collect()}
    rows = [(c, int(s), int(sum(sums.values())), centroids.centroid_digest(found.centroids[c])) for c, s in sums.items()]
    clusters = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return (members.join(F.broadcast(clusters), "cluster")
            .select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "source", "lang", "n_chars", "text")
    leaf = lambda n: merkle.leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), n, F.col("text"))
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    # As decimals: the largest long plus one has a value too.
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    tree = merkle.manifest(docs, "lang", "doc_id", leaf(F.col("n_chars")), F.when(tampered, leaf(more)))
    return tree.proofs.select(
        F.col("key").cast("bigint").alias("doc_id"), "leaf", "subroot", F.lit(tree.root).cast("string").alias("root"),
        F.sha2(F.concat_ws("", "siblings"), 256).alias("proof_sha256"), F.col("folded").alias("folded_root"),
        (F.col("folded") == F.lit(tree.root)).alias("verified"))


#: Scores from here on are predicted to be of label 1.
GOOD_FROM = 0.3


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document without id belongs to no fold: its held_out is false."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    model = zstd_quality.learn(docs, read(spark, sf_dir, "labels", "doc_id", "quality"), ~held_out)
    scored = zstd_quality.score(docs, model).drop("text")
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= GOOD_FROM).cast("int").alias("predicted"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_packing, op2_pii, op3_chat_formatting, op4_warc_revisits, op5_repeated_passages, op6_quality_rules, op7_mixing, op8_simhash, op9_nearest, op10_html_extraction,
                                    op11_centroids, op12_merkle, op13_quality_classifier)}
