"""Compression classifier: sizes against plain zstandard calls, held-out accuracy, and odd labels."""

import random
import zlib

import numpy as np
import zstandard
from pyspark.sql import functions as F

from jobmart.llm import queries, zstd_quality
from tests.paths import SF_MID


def texts(n, seed=0):
    """Sentences of two styles; label 1 in every second row."""
    r = random.Random(seed)
    words = ["the", "river", "stone", "garden", "quietly", "market", "under", "window", "old", "letters", "carried", "and"]
    for i in range(n):
        plain = [r.choice(words) for _ in range(r.randint(5, 400))]
        yield i, " ".join(plain) if i % 2 else " ".join(w.upper() + r.choice(["!!", "***", " $$$"]) for w in plain), i % 2


def tables(spark, rows, extra=""):
    d = spark.createDataFrame([(i, t, *["q"] * extra.count(",")) for i, t, _ in rows], "doc_id long, text string" + extra)
    return d, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, quality int")


def test_held_out_accuracy_and_scores_by_hand(spark):
    rows = list(texts(600))
    docs, labels = tables(spark, rows, ", score string, _text string, _id string, _y string")
    learnable = F.crc32(F.col("doc_id").cast("string")) % 5 != 0
    model = zstd_quality.learn(docs, labels, learnable)
    got = {r.doc_id: r.s for r in zstd_quality.score(docs, model, as_col="s").collect()}
    held = [(i, y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(held) > 80 and np.mean([(got[i] >= 0.5) == y for i, y in held]) > 0.98
    sizes = {}
    for name, content in (("good", model.good), ("bad", model.bad)):
        c = zstandard.ZstdCompressor(level=zstd_quality.LEVEL, dict_data=zstandard.ZstdCompressionDict(content), write_content_size=False, write_dict_id=False)
        sizes[name] = {i: sum(len(c.compress(t.encode()[at:at + zstd_quality.CHUNK])) for at in range(0, len(t.encode()), zstd_quality.CHUNK)) for i, t, _ in rows}
    for i, t, _ in rows:
        x = (sizes["bad"][i] - sizes["good"][i]) / (len(t.encode()) + zstd_quality.STEADY)
        assert abs(got[i] - 1 / (1 + np.exp(-np.clip(model.slope * x + model.base, -36, 36)))) < 1e-12


def test_labels_that_may_not_be_learned_change_nothing(spark):
    rows = list(texts(200))
    docs, labels = tables(spark, rows)
    learnable = F.crc32(F.col("doc_id").cast("string")) % 5 != 0
    flipped = labels.withColumn("quality", F.when(learnable, F.col("quality")).otherwise(1 - F.col("quality")))
    assert zstd_quality.learn(docs, labels, learnable) == zstd_quality.learn(docs, flipped, learnable)


def test_empty_null_long_equal_and_contradicting(spark):
    rows = list(texts(120))
    more = [(1000, None, 1), (1001, "", 0), (1002, "the old garden " * 200_000, 1), (1003, "é" * 3000, 0), (5, rows[5][1], 0)]
    docs, labels = tables(spark, rows + more + [(None, "the river", 1), (None, None, None)])
    model = zstd_quality.learn(docs, labels, F.lit(True))
    out = [(r.doc_id, r.text, r.score) for r in zstd_quality.score(docs, model).collect()]
    assert len(out) == len(rows) + len(more) + 2 and all(0 <= s <= 1 for *_, s in out)
    by_text = {}
    for _, t, s in out:
        by_text.setdefault(t or "", set()).add(s)
    assert all(len(s) == 1 for s in by_text.values())
    # document 5 has both labels: learning without it gives the same model
    assert model == zstd_quality.learn(docs, labels.where("doc_id is distinct from 5"), F.lit(True))


def test_one_label_no_label_and_empty_table(spark):
    docs, labels = tables(spark, [(i, t, 1) for i, t, _ in texts(20)])
    good_only = zstd_quality.learn(docs, labels, F.lit(True))
    assert {round(r.score, 9) for r in zstd_quality.score(docs, good_only).collect()} == {1.0}
    none = zstd_quality.learn(docs, labels, F.lit(False))
    assert {r.score for r in zstd_quality.score(docs, none).collect()} == {0.5}
    empty, no_labels = tables(spark, [])
    assert zstd_quality.score(empty, zstd_quality.learn(empty, no_labels, F.lit(True))).count() == 0
    tiny, two = tables(spark, [(1, "ab", 1), (2, "cd", 0), (3, "ef", 1), (4, "", 0)])
    assert len(zstd_quality.score(tiny, zstd_quality.learn(tiny, two, F.lit(True))).collect()) == 4


def test_query_on_held_out_documents(spark):
    got = queries.op13_quality_classifier(spark, SF_MID)
    truth = spark.read.parquet(f"{SF_MID}/labels.parquet").select("doc_id", "quality")
    rows = got.where("held_out").join(truth, "doc_id").collect()
    assert got.count() == spark.read.parquet(f"{SF_MID}/documents.parquet").count()
    good, bad = [r.score for r in rows if r.quality == 1], [r.score for r in rows if r.quality == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert np.mean([r.predicted for r in rows if r.quality == 1]) > 0.97
