"""Nearest neighbours against brute force: recall, order, scores, ties, invalid vectors."""

import numpy as np

from jobmart.llm import ann

SCHEMA = "vec_id bigint, embedding array<float>, label int, q bigint"


def brute(vectors, k=20, every=20):
    ids = np.array(sorted(vectors))
    x = np.array([vectors[i] for i in ids], dtype=np.float32).astype(np.float64)
    out = {}
    for q in ids[ids % every == 0]:
        s = x @ x[np.searchsorted(ids, q)]
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != q][:k]
        out[int(q)] = [(int(ids[j]), s[j]) for j in order]
    return out


def recall(rows, want):
    got = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == {q for q, w in want.items() if w}
    for q, hits in got.items():
        assert [h[0] for h in hits] == list(range(1, len(want[q]) + 1))
        assert sorted(hits, key=lambda h: (-h[2], h[1])) == hits and q not in {h[1] for h in hits}
    return np.mean([len({h[1] for h in got[q]} & {w[0] for w in want[q]}) / len(want[q]) for q in got])


def test_recall_and_scores(spark):
    r = np.random.default_rng(1)
    v = {i: x for i, x in enumerate(r.normal(size=(3000, 24)) * r.uniform(0.2, 3, (3000, 1)))}
    df = spark.createDataFrame([(i, x.tolist(), 0, 1) for i, x in v.items()], SCHEMA)
    rows, want = ann.search(df, block=100).collect(), brute(v)
    assert recall(rows, want) >= 0.9
    exact = {(q, i): s for q, w in want.items() for i, s in w}
    assert all(abs(exact[x.query_id, x.vec_id] - x.score) < 1e-9 for x in rows if (x.query_id, x.vec_id) in exact)


def test_copies_ties_and_invalid(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0], 0, 1) for i in range(60)] + [(100, [0.5, 1.0], 0, 1), (101, None, 0, 1), (120, [0.0, 0.0], 0, 1), (140, [nan, 1.0], 0, 1), (160, [inf, 1.0], 0, 1), (180, [None, 1.0], 0, 1), (200, [1.0], 0, 1), (None, [1.0, 1.0], 0, 1), (100, [0.5, 1.0], 0, 1)]
    out = sorted(ann.search(spark.createDataFrame(rows, SCHEMA)).collect(), key=lambda r: (r.query_id, r.rank))
    lists = {}
    for r in out:
        lists.setdefault(r.query_id, []).append(r.vec_id)
    assert lists == {0: list(range(1, 21)), 20: list(range(20)), 40: list(range(20)), 100: list(range(20))}


def test_few_and_none(spark):
    one = spark.createDataFrame([(0, [1.0, 2.0], 0, 1), (1, [2.0, 1.0], 0, 1)], SCHEMA)
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in ann.search(one).collect()] == [(0, 1, 1, 4.0)]
    assert ann.search(one.where("vec_id = 0")).count() == 0 and ann.search(one.where("false")).count() == 0


def test_tied_scores_keep_the_smaller_ids(spark):
    """Vectors of zeros and ones: most scores tie. With every leaf opened, ids equal brute force."""
    r = np.random.default_rng(2)
    rows = np.unique(r.integers(0, 2, (3000, 12)), axis=0)
    rows = rows[rows.any(axis=1)]
    v = {int(i): x.astype(float) for i, x in zip(r.permutation(len(rows)), rows)}
    df = spark.createDataFrame([(i, x.tolist(), 0, 1) for i, x in v.items()], SCHEMA)
    got = {}
    for x in sorted(ann.search(df, share=20.0, block=500).collect(), key=lambda x: (x.query_id, x.rank)):
        got.setdefault(x.query_id, []).append((x.vec_id, x.score))
    assert got == brute(v)
    one_hot = {i: np.eye(40)[i % 40] * (1 + i // 40) for i in range(400)}
    df = spark.createDataFrame([(i, x.tolist(), 0, 1) for i, x in one_hot.items()], SCHEMA)
    lists = {}
    for x in sorted(ann.search(df, share=20.0, block=50).collect(), key=lambda x: (x.query_id, x.rank)):
        lists.setdefault(x.query_id, []).append((x.vec_id, x.score))
    assert lists == brute(one_hot)
