"""Approximate nearest neighbours by largest inner product: a forest of random-projection trees.

* Fitting: a bounded sample (``SAMPLE`` vectors) is split again and again by the plane between two random members,
  until a leaf has at most a ``LEAVES``-th of the sample (at least ``LEAST_LEAF``). The forest's size is bounded, so it may
  be sent to every task, and a query visits as many leaves whatever the number of rows. An extra coordinate makes the largest inner product the nearest point.
* Indexing: every row is routed to its leaf in every tree. Equal vectors are one entry with its smallest ids:
  no more than ``k + 1`` ids of one vector can be in any answer, so the rest need no entry (exact).
* Searching: one priority queue over the nodes of all trees, ordered by the smallest margin on the way, gives a
  query its leaves until, over all trees, they hold ``SHARE`` times as many vectors as the sample.
* Reranking: leaf members and the queries that chose the leaf meet in one group; leaves of more than ``BLOCK``
  members are dealt out in blocks, with the queries sent to each block. Scores are inner products of the original
  vectors in double precision; each group passes on its best, and the best of all are kept.

Defined results: vectors that are null, zero, hold null or non-finite components, or differ in length from most,
take no part, as do rows without an id; repeated rows count once per (id, vector); an empty table gives none.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobmart.llm.common import staged

TREES, LEAVES, LEAST_LEAF, SAMPLE, SHARE, BLOCK, SEED = 10, 64, 32, 50_000, 1.5, 8192, 7
K = 20


class Forest:
    """Trees as flat arrays: planes, offsets, children (a leaf has the negative of its number, less one)."""

    def __init__(self, points: np.ndarray, trees: int, leaf: int, seed: int):
        rng = np.random.default_rng(seed)
        self.normals, self.offsets, self.children, self.roots, self.sizes = [], [], [], [], []
        for _ in range(trees):
            self.roots.append(self._split(points, np.arange(len(points)), leaf, rng))
        self.normals = np.array(self.normals, dtype=np.float64).reshape(-1, points.shape[1])
        self.offsets = np.array(self.offsets, dtype=np.float64)

    def _leaf(self, rows) -> int:
        self.sizes.append(len(rows))
        return -len(self.sizes)

    def _split(self, points, rows, leaf, rng, depth: int = 0) -> int:
        if len(rows) <= leaf or depth > 40:
            return self._leaf(rows)
        for _ in range(8):
            a, b = points[rng.choice(rows, 2, replace=False)]
            normal = a - b
            if normal.any():
                normal /= np.linalg.norm(normal)
                offset = float(normal @ (a + b) / 2)
                side = points[rows] @ normal > offset
                if 0.05 < side.mean() < 0.95:
                    break
        else:
            return self._leaf(rows)
        me = len(self.children)
        self.normals.append(normal)
        self.offsets.append(offset)
        self.children.append(None)
        self.children[me] = (self._split(points, rows[~side], leaf, rng, depth + 1), self._split(points, rows[side], leaf, rng, depth + 1))
        return me

    def margins(self, x: np.ndarray) -> np.ndarray:
        return x @ self.normals.T - self.offsets

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf numbers of every row, one column per tree."""
        m, out = self.margins(x), np.empty((len(x), len(self.roots)), dtype=np.int64)
        for i in range(len(x)):
            for t, n in enumerate(self.roots):
                while n >= 0:
                    n = self.children[n][int(m[i, n] > 0)]
                out[i, t] = -n - 1
        return out

    def search(self, x: np.ndarray, enough: int) -> list[list[int]]:
        """The leaves of every query, nearest first by the shared queue, until they hold ``enough`` sample vectors."""
        out = []
        for m in self.margins(x):
            heap, found, total = [(-np.inf, r) for r in self.roots], [], 0
            heapq.heapify(heap)
            while heap and total < enough:
                p, n = heapq.heappop(heap)
                if n < 0:
                    found.append(-n - 1)
                    total += self.sizes[-n - 1]
                else:
                    low, high = self.children[n]
                    d = float(m[n])
                    heapq.heappush(heap, (max(p, d), low))
                    heapq.heappush(heap, (max(p, -d), high))
            out.append(found)
        return out


def _matrix(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def _valid(vectors: DataFrame) -> DataFrame:
    v = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<float>").alias("embedding")).where("vec_id is not null and embedding is not null")
    fine = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("embedding", lambda x: x != 0)
    v = v.where(F.coalesce(fine, F.lit(False)))
    # equal vectors are equal arrays: -0.0 becomes 0.0
    return v.withColumn("embedding", F.transform("embedding", lambda x: x + F.lit(0.0).cast("float"))).dropDuplicates(["vec_id", "embedding"])


def search(vectors: DataFrame, k: int = K, every: int = 20, trees: int = TREES, leaves: int = LEAVES, sample: int = SAMPLE, share: float = SHARE, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every row whose id is divisible by ``every``."""
    v = staged(_valid(vectors), "vectors")
    dims = v.groupBy(F.size("embedding").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    empty = "query_id bigint, rank int, vec_id bigint, score double"
    if dims is None:
        return vectors.sparkSession.createDataFrame([], empty)
    v = v.where(F.size("embedding") == dims["d"])
    total = dims["n"]
    # the index: one entry for each different vector, with its k + 1 smallest ids
    order = Window.partitionBy("embedding").orderBy("vec_id")
    few = v.withColumn("_i", F.row_number().over(order)).where(F.col("_i") <= k + 1)
    entries = staged(few.groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select(F.get("ids", 0).alias("entry"), "ids", "embedding"), "entries")
    wanted = v.where(F.col("vec_id") % every == 0)
    queries = staged(wanted.groupBy("embedding").agg(F.min("vec_id").alias("q")), "queries")
    bound = float(entries.agg(F.sqrt(F.max(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))))).first()[0])

    def lifted(x):
        return np.hstack([x, np.sqrt(np.maximum(bound * bound - (x * x).sum(axis=1, keepdims=True), 0))])

    chosen = entries.select("embedding", F.xxhash64("entry", F.lit(SEED)).alias("h")).where(
        F.pmod("h", F.lit(1_000_000)) < int(min(1.0, 1.2 * sample / max(total, 1)) * 1_000_000) + 1).orderBy("h").limit(sample).select("embedding").toPandas()
    forest = Forest(lifted(np.array(chosen["embedding"].tolist(), dtype=np.float64)), trees, max(LEAST_LEAF, len(chosen) // leaves), SEED)
    enough = int(share * len(chosen))
    shared = vectors.sparkSession.sparkContext.broadcast(forest)

    def route(batches):
        import pyarrow as pa

        for b in batches:
            for i in range(0, b.num_rows, 1024):
                part = b.slice(i, 1024)
                at = shared.value.leaves(lifted(_matrix(part.column(1))))
                n = at.shape[1]
                yield pa.RecordBatch.from_pydict({"leaf": at.ravel(), "id": np.repeat(part.column(0).to_numpy(), n), "embedding": part.column(1).take(pa.array(np.repeat(np.arange(len(part)), n)))})

    def ask(batches):
        import pyarrow as pa

        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                x = _matrix(part.column(1))
                found = shared.value.search(np.hstack([x, np.zeros((len(x), 1))]), enough)
                n = [len(f) for f in found]
                yield pa.RecordBatch.from_pydict({"leaf": np.array([y for f in found for y in f], dtype=np.int64), "id": np.repeat(part.column(0).to_numpy(), n),
                                                  "embedding": part.column(1).take(pa.array(np.repeat(np.arange(len(part)), n)))})

    schema = "leaf bigint, id bigint, embedding array<float>"
    members = staged(entries.select("entry", "embedding").mapInArrow(route, schema), "members")
    asked = queries.select("q", "embedding").mapInArrow(ask, schema)
    blocks = staged(members.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("m")), "blocks").withColumnRenamed("leaf", "_leaf")
    have = members.join(blocks, F.col("leaf") == F.col("_leaf")).select("leaf", F.pmod(F.xxhash64("id"), F.col("m")).cast("int").alias("b"), F.lit(0).alias("kind"), "id", "embedding")
    want = asked.join(blocks, F.col("leaf") == F.col("_leaf")).select("leaf", F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("b"), F.lit(1).alias("kind"), "id", "embedding")
    groups = have.unionByName(want).repartition("leaf", "b").sortWithinPartitions("leaf", "b", "kind")

    def rerank(batches):
        import pyarrow as pa

        group, ids, rows = None, [], []

        def best(q_ids, q):
            own, x = np.concatenate(ids), np.concatenate(rows)
            rough = q @ x.T
            if len(own) > k + 1:
                # every member that rounding leaves a chance, ties of the last place included
                last = -np.partition(-rough, k, axis=1)[:, k]
                room = 1e-12 * np.linalg.norm(q, axis=1) * np.linalg.norm(x, axis=1).max()
                at, member = np.nonzero(rough >= (last - room)[:, None])
            else:
                at, member = (a.ravel() for a in np.indices(rough.shape))
            score = np.empty(len(at))
            for i in range(0, len(at), 65_536):
                # the same sum for a pair wherever it is met: not a block product, whose order of adding depends on its shape
                score[i:i + 65_536] = (q[at[i:i + 65_536]] * x[member[i:i + 65_536]]).sum(axis=1)
            order = np.lexsort((own[member], -score, at))
            at, member, score = at[order], member[order], score[order]
            kept = np.arange(len(at)) - np.searchsorted(at, at) <= k
            return q_ids[at[kept]], own[member[kept]], score[kept]

        for b in batches:
            if not b.num_rows:
                continue
            key = [b.column(c).to_numpy() for c in range(3)]
            cuts = [0, *(np.flatnonzero(np.any([c[1:] != c[:-1] for c in key], axis=0)) + 1).tolist(), b.num_rows]
            for s, e in zip(cuts, cuts[1:]):
                at, kind = (int(key[0][s]), int(key[1][s])), int(key[2][s])
                if at != group:
                    group, ids, rows = at, [], []
                part = b.slice(s, e - s)
                if kind == 0:
                    ids.append(part.column(3).to_numpy())
                    rows.append(_matrix(part.column(4)))
                elif ids:
                    for i in range(0, e - s, 256):
                        one = part.slice(i, 256)
                        q, d, sc = best(one.column(3).to_numpy(), _matrix(one.column(4)))
                        yield pa.RecordBatch.from_pydict({"q": q, "entry": d, "score": sc})

    found = groups.mapInArrow(rerank, "q bigint, entry bigint, score double").groupBy("q", "entry").agg(F.max("score").alias("score"))
    nearest = Window.partitionBy("q").orderBy(F.desc("score"), "entry")
    found = found.withColumn("_r", F.row_number().over(nearest)).where(F.col("_r") <= k + 1).select("q", "entry", "score")
    found = staged(found.join(entries.select("entry", "ids"), "entry").select("q", "score", F.explode("ids").alias("vec_id")), "found")
    # no more than k + 1 answers of a query vector matter to any of its rows
    found = found.withColumn("_r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))).where(F.col("_r") <= k + 1)
    lists = found.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("_r", "vec_id", "score"))).alias("hits"))
    rows = wanted.join(queries.select(F.col("embedding").alias("_e"), "q"), F.col("embedding") == F.col("_e")).select(F.col("vec_id").alias("query_id"), "q")
    hits = rows.join(lists, "q").select("query_id", F.slice(F.filter("hits", lambda h: h["vec_id"] != F.col("query_id")), 1, k).alias("hits"))
    return hits.select("query_id", F.posexplode("hits").alias("_p", "_h")).select("query_id", (F.col("_p") + 1).cast("int").alias("rank"), "_h.vec_id", "_h.score")
