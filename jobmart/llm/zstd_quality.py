"""Quality classifier by compression: a text is good if a dictionary of good texts shortens it more than one of bad texts.

Two zstandard dictionaries are built from pieces of labelled texts, one for each label. A text is cut into chunks, so
that a dictionary counts for all of it and not only for its beginning, and every chunk is compressed with both. The
difference of the two compressed sizes, over the text's own size, is mapped to a probability by a logistic curve
that is fitted on labelled texts which the dictionaries have not seen, weighted by how often the labels occur.

The dictionaries and the curve come from a bounded sample of labelled documents (``SAMPLE`` for each label, for the
dictionaries and again for the curve), chosen by a hash of the id; all else is one pass over the whole texts.
A document's label is used only if ``learnable`` allows it. Labels, ids and all other columns are never inputs of
a score: equal texts have equal scores.

Defined results: a null text is an empty one, and an empty text has a score like any other (no difference). A
document with labels that contradict each other is not learned from; repeated rows count once in learning and get a
score each. Without a label of one kind every score is the share of label 1, without any label it is 0.5. An empty
table returns no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled documents of each label that the dictionaries are built from; as many others fit the curve.
SAMPLE = 1500
#: Pieces of a document that go into a dictionary, and their bytes.
PIECES, PIECE = 2, 256
#: Bytes of a dictionary, of a chunk of text, and the level of compression.
DICTIONARY, CHUNK, LEVEL = 112_640, 1024, 3
#: Added to a text's size, so that the few bytes of a short text decide little.
STEADY = 200


@dataclass
class Model:
    """Dictionaries by label (either may be missing) and the curve: P(label 1) = 1 / (1 + exp(-(slope * x + base)))."""

    good: bytes | None
    bad: bytes | None
    slope: float
    base: float

    def scores(self, texts: pd.Series) -> pd.Series:
        x = np.zeros(len(texts)) if self.good is None or self.bad is None else differences(texts, self.good, self.bad)
        return pd.Series(1 / (1 + np.exp(-np.clip(self.slope * x + self.base, -36, 36))))


def dictionary(pieces: list[bytes]) -> bytes | None:
    """A trained dictionary; of too little text to train one, the text itself."""
    pieces = sorted(set(p for p in pieces if p))
    try:
        return zstandard.train_dictionary(DICTIONARY, pieces).as_bytes()
    except zstandard.ZstdError:
        raw = b"\n".join(pieces)[-DICTIONARY:]
        return raw if len(raw) >= 8 else None


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    made = zstandard.ZstdCompressionDict(content)
    made.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=made, write_content_size=False, write_checksum=False, write_dict_id=False)


def differences(texts: pd.Series, good: bytes, bad: bytes) -> np.ndarray:
    """Bytes that the good dictionary saves against the bad one, as a share of the text's bytes."""
    by_good, by_bad = _compressor(good), _compressor(bad)
    out = np.empty(len(texts))
    for i, text in enumerate(texts):
        raw = text.encode() if text else b""
        saved = 0
        for at in range(0, len(raw), CHUNK):
            chunk = raw[at:at + CHUNK]
            saved += len(by_bad.compress(chunk)) - len(by_good.compress(chunk))
        out[i] = saved / (len(raw) + STEADY)
    return out


def curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and base of a weighted logistic curve (Newton steps, with a small ridge so that it always exists)."""
    spread = x.std() or 1.0
    z = np.column_stack([x / spread, np.ones(len(x))])
    # Targets short of 0 and 1, by the number of rows: a curve through separated classes stays finite.
    target = np.where(y == 1, 1 - 1 / (2 + (y == 1).sum()), 1 / (2 + (y == 0).sum()))
    beta, ridge = np.zeros(2), np.diag([1e-3, 1e-9])

    def loss(b: np.ndarray) -> float:
        s = z @ b
        return float((weight * (np.logaddexp(0, s) - target * s)).sum() + b @ ridge @ b / 2)

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -36, 36)))
        grad = z.T @ (weight * (target - p)) - ridge @ beta
        step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + ridge + 1e-12 * np.eye(2), grad)
        while loss(beta + step) > loss(beta) and np.abs(step).max() > 1e-12:
            step /= 2
        beta = beta + step
        if np.abs(step).max() < 1e-10:
            break
    return float(beta[0] / spread), float(beta[1])


def _share(ones: int, zeros: int) -> float:
    """The base of a curve without slope that gives the share of label 1."""
    if not ones + zeros:
        return 0.0
    return 36.0 if not zeros else -36.0 if not ones else float(np.log(ones / zeros))


def _piece(raw: Column, i: int) -> Column:
    """Piece ``i`` of a text's bytes, its place chosen by the text's hash."""
    places = F.greatest(F.ceil(F.octet_length(raw) / PIECE), F.lit(1))
    at = F.pmod(F.xxhash64(raw, F.lit(i)), places) * PIECE + 1
    return F.substring(raw, at.cast("int"), F.lit(PIECE))


def learn(docs: DataFrame, labels: DataFrame, learnable: Column, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", sample: int = SAMPLE) -> Model:
    """``learnable``: a condition on ``labels`` that says which of its rows may be learned from."""
    spark = docs.sparkSession
    label = F.col(f"`{label_col}`")
    docs = docs.select(F.col(f"`{id_col}`").alias("_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text"))
    one = labels.where(learnable & label.isin(0, 1)).groupBy(F.col(f"`{id_col}`").alias("_id")).agg(F.min(label).alias("_y"), F.max(label).alias("_z"))
    known = one.where("_y = _z").select("_id", "_y").join(docs.select("_id"), "_id", "left_semi")
    counts = {r["_y"]: r["n"] for r in known.groupBy("_y").agg(F.count("*").alias("n")).collect()}
    ones, zeros = counts.get(1, 0), counts.get(0, 0)
    if not ones or not zeros:
        return Model(None, None, 0.0, _share(ones, zeros))

    # At most 4 * sample ids: of each label, every second one is for the dictionary.
    picked = [(r["_id"], y, i % 2 == 0) for y in (0, 1)
              for i, r in enumerate(known.where(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(2 * sample).collect())]
    chosen = docs.join(F.broadcast(spark.createDataFrame(picked, "_id long, _y int, _for_dict boolean")), "_id")

    raw = F.encode("_text", "utf-8")
    pieces = (chosen.where("_for_dict").select("_id", "_y", F.array(*[_piece(raw, i) for i in range(PIECES)]).alias("_p"))
              .groupBy("_id", "_y").agg(F.min("_p").alias("_p")).collect())
    good, bad = (dictionary([bytes(p) for r in pieces if r["_y"] == y for p in r["_p"]]) for y in (1, 0))
    if good is None or bad is None:
        return Model(None, None, 0.0, _share(ones, zeros))

    measured = F.pandas_udf(lambda texts: pd.Series(differences(texts, good, bad)), "double")
    rows = (chosen.where("not _for_dict").select("_id", "_y", measured("_text").alias("_x"))
            .groupBy("_id", "_y").agg(F.min("_x").alias("_x")).collect())
    x, y = np.array([r["_x"] for r in rows], dtype="f8"), np.array([r["_y"] for r in rows], dtype="i8")
    if len(set(y.tolist())) < 2:
        return Model(None, None, 0.0, _share(ones, zeros))
    # The sample holds as many of either label; the weights restore how often they occur.
    weight = np.where(y == 1, ones / (y == 1).sum(), zeros / (y == 0).sum())
    return Model(good, bad, *curve(x, y, weight * len(y) / weight.sum()))


def score(docs: DataFrame, model: Model, text_col: str = "text", as_col: str = "score") -> DataFrame:
    """The documents with P(label 1) of every whole text; all columns stay."""
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield model.scores(texts)

    scores.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return docs.withColumn(as_col, F.pandas_udf(scores, "double")(F.col(f"`{text_col}`")))
