"""Centroid clustering with heap-ordered bounds: Lloyd's rounds that rescan only vectors whose bound has expired.

Every vector keeps an upper bound on the distance to its own centroid and a lower bound on the distance to the
others. A round of moving centroids shrinks the gap of all vectors of one cluster by the same amount, so the gap
is stored once, offset by the drift its cluster had accumulated, and the gaps of a cluster lie in a heap: a round
pops only those that the drift has overtaken and measures them against every centroid. All others keep their
centroid, unread. Components are integers, so distances, sums and ties are exact; only the bounds are floating,
rounded so that an expired gap is never missed.

How it runs: the vectors are packed into blocks of ``BLOCK`` rows and written once, bucketed by block. What a round
changes (the heaps, as bytes) is a second, small table bucketed alike, so a round joins the two in place: no vector
is shuffled or rewritten. A round sends the driver nothing but the k sums that changed, added up by Spark. Blocks
are cut from the scan, so no key decides their size.

Defined results: rows whose vector is null, has another length, or holds a null or non-finite component take no
part. Repeated rows are vectors of their own and return one row each. A row without id is clustered; it becomes a
starting centroid only if too few others exist. Ties of hashes (repeated ids) are ordered by the vector. With fewer
vectors than centroids, each vector starts one. An empty table returns no rows. A component beyond ``LARGEST`` is an
error: its squared distances would not fit a long. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
import uuid
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobmart.llm.common import staged
from jobmart.session import shared_dir

#: Vectors in a block: a block of 64 components is a megabyte.
BLOCK = 4096
#: Scaled components are at most this, so that 64 squared differences and their sum stay below 2^63.
LARGEST = 2 ** 27
#: Bounds are widened by this share, far above the rounding of the square roots and sums that they are made of.
SLACK = 1e-12

VECTORS = "block bigint, ids binary, no_id binary, vectors binary"
STATE = "block bigint, cluster binary, heap binary, moved binary, rescanned bigint"
MEMBERS = "id bigint, cluster int, distance bigint"


@dataclass
class Clustering:
    """``members``: (id, cluster, distance), one row per vector; ``centroids``: exact integers;
    ``rescanned``: vectors measured against every centroid, round by round."""

    members: DataFrame
    centroids: np.ndarray
    rescanned: list[int]


def usable(vector: Column, dim: int) -> Column:
    """``dim`` components, none of them null, NaN or infinite."""
    inf = F.lit(float("inf"))
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != inf))
    return F.coalesce((F.size(vector) == dim) & fine, F.lit(False))


def scaled(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component, as doubles (exact: the floor of a product by a power of two)."""
    # floor() returns a long, which a huge component would overflow in silence: it is left as it is, for _pack() to find.
    def floor(x: Column) -> Column:
        return F.when(F.abs(x) <= LARGEST, F.floor(x).cast("double")).otherwise(x)

    return F.transform(vector, lambda x: floor(x.cast("double") * scale))


def _pack(batches, dim: int):
    """Blocks of at most BLOCK vectors from one partition of the scan."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    rest = pd.DataFrame({"id": [], "no_id": [], "v": []})

    def block(rows: pd.DataFrame) -> pd.DataFrame:
        nonlocal number
        number += 1
        vecs = np.vstack(rows["v"].to_numpy())
        if np.abs(vecs).max() > LARGEST:
            raise ValueError(f"a scaled component exceeds {LARGEST}: squared distances would not fit a long")
        return pd.DataFrame([(number, rows["id"].to_numpy("int64").tobytes(), rows["no_id"].to_numpy("bool").tobytes(),
                              vecs.astype("int32").tobytes())], columns=["block", "ids", "no_id", "vectors"])

    for batch in batches:
        rest = pd.concat([rest, batch], ignore_index=True) if len(rest) else batch
        while len(rest) >= BLOCK:
            yield block(rest[:BLOCK])
            rest = rest[BLOCK:]
    if len(rest):
        yield block(rest)


def squared(vecs: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, rows by centroids; all terms stay below 2^63 by LARGEST."""
    return (vecs * vecs).sum(1)[:, None] - 2 * (vecs @ centroids.T) + (centroids * centroids).sum(1)[None, :]


class Heaps:
    """The heaps of one block: a heap of (gap + drift at insertion, row) for every cluster."""

    def __init__(self, k: int, cluster: np.ndarray, heaps: list[list[tuple[float, int]]]):
        self.k, self.cluster, self.heaps = k, cluster, heaps

    @classmethod
    def of(cls, k: int, cluster: bytes, heap: bytes) -> "Heaps":
        """Read back as written: the heap order is the order in the bytes."""
        owner = np.frombuffer(cluster, dtype="int32").copy()
        rows = np.frombuffer(heap, dtype=[("cluster", "i4"), ("row", "i4"), ("key", "f8")])
        heaps = [[] for _ in range(k)]
        for c in range(k):
            mine = rows[rows["cluster"] == c]
            heaps[c] = list(zip(mine["key"].tolist(), mine["row"].tolist()))
        return cls(k, owner, heaps)

    def bytes(self) -> tuple[bytes, bytes]:
        flat = [(c, row, key) for c, heap in enumerate(self.heaps) for key, row in heap]
        return self.cluster.tobytes(), np.array(flat, dtype=[("cluster", "i4"), ("row", "i4"), ("key", "f8")]).tobytes()

    def expired(self, drift: np.ndarray) -> np.ndarray:
        """Pops the rows whose gap the accumulated drift of their cluster has used up."""
        out = []
        for heap, used in zip(self.heaps, drift):
            while heap and heap[0][0] <= used:
                out.append(heapq.heappop(heap)[1])
        return np.array(sorted(out), dtype="int64")

    def measure(self, rows: np.ndarray, vecs: np.ndarray, centroids: np.ndarray, drift: np.ndarray) -> None:
        """Measures rows against every centroid and pushes their new gaps."""
        dist = squared(vecs, centroids)
        nearest = dist.argmin(1)  # ties: the smaller number
        self.cluster[rows] = nearest
        upper = np.sqrt(dist[np.arange(len(rows)), nearest].astype("f8"))
        if self.k > 1:
            dist[np.arange(len(rows)), nearest] = np.iinfo("int64").max
            lower = np.sqrt(dist.min(1).astype("f8"))
        else:
            lower = np.full(len(rows), np.inf)
        keys = lower * (1 - SLACK) - upper * (1 + SLACK) + drift[nearest]
        for row, c, key in zip(rows.tolist(), nearest.tolist(), keys.tolist()):
            heapq.heappush(self.heaps[c], (key, row))


def _assign(vecs: np.ndarray, state: tuple[bytes, bytes] | None, centroids: np.ndarray, drift: np.ndarray):
    """One round on one block: (heaps, sums that left and entered each cluster with their counts, rows rescanned)."""
    k = len(centroids)
    moved = np.zeros((k, centroids.shape[1] + 1), dtype="int64")  # components, then the count
    if state is None:
        heaps, before = Heaps(k, np.full(len(vecs), -1, dtype="int32"), [[] for _ in range(k)]), None
        rows = np.arange(len(vecs))
    else:
        heaps = Heaps.of(k, *state)
        rows = heaps.expired(drift)
        before = heaps.cluster[rows].copy()
    if len(rows):
        some = vecs[rows]
        heaps.measure(rows, some, centroids, drift)
        after = heaps.cluster[rows]
        change = np.ones(len(rows), dtype=bool) if before is None else before != after
        counted = np.column_stack([some[change], np.ones(change.sum(), dtype="int64")])
        np.add.at(moved, after[change], counted)
        if before is not None:
            np.subtract.at(moved, before[change], counted)
    return heaps, moved, len(rows)


def _round(batches, centroids: np.ndarray, drift: np.ndarray):
    for batch in batches:
        out = []
        for r in batch.itertuples(index=False):
            vecs = np.frombuffer(r.vectors, dtype="int32").reshape(-1, centroids.shape[1]).astype("int64")
            old = getattr(r, "cluster", None)
            heaps, moved, n = _assign(vecs, (old, r.heap) if old is not None else None, centroids, drift)
            out.append((r.block, *heaps.bytes(), moved.tobytes(), n))
        yield pd.DataFrame(out, columns=["block", "cluster", "heap", "moved", "rescanned"])


def _sums(batches, k: int, dim: int):
    """What a round moved as (cluster, component, total) rows, added up per Arrow batch; cluster -1: rows rescanned."""
    for batch in batches:
        if len(batch):
            total = sum(np.frombuffer(m, dtype="int64").reshape(k, dim + 1).astype(object) for m in batch["moved"])
            rows = [(c, i, str(total[c][i])) for c in range(k) for i in range(dim + 1)]
            yield pd.DataFrame([*rows, (-1, 0, str(batch["rescanned"].sum()))], columns=["cluster", "component", "total"])


def _members(batches, centroids: np.ndarray):
    for batch in batches:
        for r in batch.itertuples(index=False):
            vecs = np.frombuffer(r.vectors, dtype="int32").reshape(-1, centroids.shape[1]).astype("int64")
            cluster = np.frombuffer(r.cluster, dtype="int32")
            diff = vecs - centroids[cluster]
            ids = pd.array(np.frombuffer(r.ids, dtype="int64"), dtype="Int64")
            ids[np.frombuffer(r.no_id, dtype=bool)] = pd.NA
            yield pd.DataFrame({"id": ids, "cluster": cluster, "distance": (diff * diff).sum(1)})


def _bucketed(df: DataFrame, name: str, buckets: int) -> DataFrame:
    """Written to the shared folder, bucketed by block, so that a join on it needs no exchange."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    (df.write.bucketBy(buckets, "block").sortBy("block").option("path", f"{shared_dir(spark)}/{table}")
     .saveAsTable(table))
    out = spark.table(table)
    spark.sql(f"DROP TABLE {table}")  # external: only the catalog's entry goes, the files stay
    return out


def _centroids(sums: list[list[int]], before: np.ndarray) -> np.ndarray:
    """Componentwise floor(sum / count); a cluster without vectors stays."""
    return np.array([[s // row[-1] for s in row[:-1]] if row[-1] else old for row, old in zip(sums, before.tolist())], dtype="int64")


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 8, rounds: int = 10,
            dim: int = 64, scale: int = 1024, seed: int = 3) -> Clustering:
    """``rounds`` rounds of assigning and averaging, then one more assignment."""
    spark = vectors.sparkSession
    v = F.col(f"`{vector_col}`")
    kept = vectors.where(usable(v, dim)).select(F.col(f"`{id_col}`").cast("bigint").alias("id"), scaled(v, scale).alias("v"))
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = kept.orderBy(key.asc_nulls_last(), "v").limit(k).collect()  # k vectors
    if not first:
        return Clustering(spark.createDataFrame([], MEMBERS), np.empty((0, dim), dtype="int64"), [])
    centroids = np.array([r["v"] for r in first]).astype("int64")
    k = len(centroids)

    rows = kept.select(F.coalesce("id", F.lit(0)).alias("id"), F.col("id").isNull().alias("no_id"), "v")
    packed = staged(rows.mapInPandas(lambda b: _pack(b, dim), VECTORS), "vector-blocks")
    # At most about 64 MB of vectors a bucket, so a task's share stays the same as the table grows.
    buckets = max(spark.sparkContext.defaultParallelism, packed.count() * BLOCK * dim * 4 // 2 ** 26)
    blocks = _bucketed(packed.repartition(buckets, "block"), "vector_blocks", buckets)

    drift, sums, rescanned, state = np.zeros(k), [[0] * (dim + 1) for _ in range(k)], [], None
    for turn in range(rounds + 1):
        rows = blocks.select("block", "vectors")
        rows = rows if state is None else rows.join(state.select("block", "cluster", "heap"), "block")
        now, used = centroids, drift
        state = _bucketed(rows.mapInPandas(lambda b: _round(b, now, used), STATE), "cluster_heaps", buckets)
        moved = (state.select("moved", "rescanned")
                 .mapInPandas(lambda b: _sums(b, k, dim), "cluster int, component int, total string")
                 .groupBy("cluster", "component").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")))
        for r in moved.collect():  # k * (dim + 1) sums and a count
            if r["cluster"] < 0:
                rescanned.append(int(r["total"]))
            else:
                sums[r["cluster"]][r["component"]] += int(r["total"])
        if turn == rounds:
            break
        new = _centroids(sums, centroids)
        step = np.sqrt(((new - centroids) ** 2).sum(1).astype("f8")) * (1 + SLACK)
        # A gap shrinks by what its own centroid moved and by the most that any other one did.
        other = np.array([max([s for j, s in enumerate(step) if j != c], default=0.0) for c in range(k)])
        drift, centroids = (drift + step + other) * (1 + SLACK), new
    final = blocks.join(state.select("block", "cluster"), "block")
    return Clustering(final.mapInPandas(lambda b: _members(b, centroids), MEMBERS), centroids, rescanned)


def centroid_digest(centroid) -> str:
    """Lowercase hex sha256 of the components as decimal integers joined by commas."""
    return hashlib.sha256(",".join(str(int(x)) for x in centroid).encode()).hexdigest()
