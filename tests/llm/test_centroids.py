"""Heap-ordered clustering against plain rounds, exactly, and how much its bounds save."""

import hashlib

import numpy as np
import pytest

from jobmart.llm import centroids

SCHEMA = "vec_id long, embedding array<double>"


def plain(rows, k, rounds, dim, seed=3, scale=1024):
    """(id, cluster, distance) of every usable row, sorted, and the centroids; Python integers throughout."""
    kept = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and np.isfinite(x) for x in v)]
    key = lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    cs = [v for _, v in sorted(kept, key=key)[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cs))
    for turn in range(rounds + 1):
        got = [(i, *near(v), v) for i, v in kept]
        if turn < rounds:
            mine = [[v for _, _, c, v in got if c == j] for j in range(len(cs))]
            cs = [[sum(x) // len(vs) for x in zip(*vs)] if vs else c for vs, c in zip(mine, cs)]
    return sorted(((i, c, d) for i, d, c, _ in got), key=str), cs


def found(spark, rows, extra=(), **how):
    data = [(*r, *["x"] * len(extra)) for r in rows]
    df = spark.createDataFrame(data, ", ".join([SCHEMA, *[f"{c} string" for c in extra]]))
    out = centroids.cluster(df, **how)
    return sorted(((r["id"], r["cluster"], r["distance"]) for r in out.members.collect()), key=str), out


def blobs(n, dim, spread, seed):
    r = np.random.default_rng(seed)
    middles = r.normal(0, 1, (6, dim))
    return [(int(i), (middles[i % 6] + r.normal(0, spread, dim)).tolist()) for i in r.permutation(n)]


@pytest.mark.parametrize("spread,rounds,k", [(0.05, 5, 8), (1.0, 4, 5)])
def test_equals_plain_rounds(spark, spread, rounds, k):
    rows = blobs(400, 6, spread, 7)
    got, out = found(spark, rows, dim=6, k=k, rounds=rounds)
    want, cs = plain(rows, k, rounds, 6)
    assert got == want and out.centroids.tolist() == cs
    assert out.rescanned[0] == 400 and len(out.rescanned) == rounds + 1


def test_only_expired_gaps_are_rescanned(spark):
    """Far clusters that have settled: later rounds measure next to nothing."""
    _, out = found(spark, blobs(600, 6, 0.01, 3), dim=6, k=4, rounds=6)
    assert out.rescanned[0] == 600 and sum(out.rescanned[1:]) < 2 * 600 and out.rescanned[4:] == [0, 0, 0]


def test_ties_equal_rows_nulls_and_clashing_columns(spark):
    grid = [(i, [float(i % 3), float(i // 3 % 3), 0.0]) for i in range(40)]  # many equal vectors and equal distances
    odd = [(None, [1.0, 1.0, 0.0]), (None, [0.5, 0.5, 0.5]), (50, None), (51, [1.0, 2.0]), (52, [1.0, None, 2.0]),
           (53, [1.0, float("nan"), 2.0]), (54, [1.0, float("inf"), 2.0]), (55, []), (0, [0.0, 0.0, 0.0]), (0, [0.0, 0.0, 0.0]),
           (2 ** 60 + 1, [-0.3, -0.7, -1e-9])]
    rows = grid + odd
    got, out = found(spark, rows, extra=("id", "v", "block", "cluster", "distance"), dim=3, k=8, rounds=3)
    want, cs = plain(rows, 8, 3, 3)
    assert got == want and out.centroids.tolist() == cs


def test_fewer_vectors_than_centroids_and_none(spark):
    got, out = found(spark, [(1, [0.0, 1.0]), (2, [5.0, 5.0])], dim=2, k=8, rounds=2)
    assert [d for *_, d in got] == [0, 0] and len(out.centroids) == 2
    got, _ = found(spark, [(1, [0.0, 1.0])] * 3, dim=2, k=1, rounds=2)
    assert got == [(1, 0, 0)] * 3
    assert found(spark, [], dim=2)[0] == [] and found(spark, [(1, None)], dim=2)[0] == []


def test_components_beyond_a_long_are_an_error(spark):
    with pytest.raises(Exception, match="would not fit a long"):
        found(spark, [(1, [1e30, 0.0]), (2, [0.0, 0.0])], dim=2)
    got, _ = found(spark, [(1, [1e5, 0.0]), (2, [-1e5, 0.0])], dim=2, k=1, rounds=0)
    assert max(d for *_, d in got) == (2 * 102_400_000) ** 2


def test_heaps_survive_being_written():
    heaps = centroids.Heaps(2, np.full(5, -1, dtype="int32"), [[], []])
    vecs = np.array([[0, 0], [1, 0], [9, 9], [8, 9], [4, 4]])
    heaps.measure(np.arange(5), vecs, np.array([[0, 0], [9, 9]]), np.zeros(2))
    again = centroids.Heaps.of(2, *heaps.bytes())
    assert again.heaps == heaps.heaps and again.cluster.tolist() == [0, 0, 1, 1, 0]
    nearest_gap = min(heaps.heaps[0])[1]
    assert nearest_gap == 4 and again.expired(np.array([again.heaps[0][0][0], 0.0])).tolist() == [4]
