"""Mixing: targets by the plain rule, copies near them, reruns agree."""

import random
from collections import Counter, defaultdict

import pytest

from jobmart.llm import mixing


def plain_targets(sizes, weights=mixing.WEIGHTS, cap=mixing.CAP):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    fixed, left = {}, float(sum(sizes.values()))
    while True:
        open_ = [s for s in names if s not in fixed]
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > cap * sizes[s]]
        if not over:
            return {**fixed, **share}
        for s in over:
            fixed[s] = cap * sizes[s]
            left -= fixed[s]


def table(docs, seed=2):
    r = random.Random(seed)
    rows = [(i, "w " * r.choice((0, 1, 5, 40, 41, 300)), r.choice(["a"] * 12 + ["b", "c", "d", "é", None])) for i in range(1500)]
    return docs(rows + [(None, "null id", "a"), (7777, None, "zz")])


def test_targets_and_copies(spark, docs):
    df = table(docs)
    rows = mixing.mix_report(df).collect()
    assert len(rows) == df.count() and sorted(map(str, rows)) == sorted(map(str, mixing.mix_report(df).collect()))
    source = {r.doc_id: r.source for r in df.collect() if r.doc_id != 7777}
    sizes, taken, target, largest = defaultdict(int), defaultdict(int), {}, defaultdict(int)
    for r in rows:
        if r.doc_id == 7777:
            continue
        s = source[r.doc_id]
        sizes[s] += r.size
        taken[s] += r.taken
        target[s] = r.target
        largest[s] = max(largest[s], r.size)
        assert r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
    want = plain_targets({**{s: next(r.source_size for r in rows if r.doc_id != 7777 and source[r.doc_id] == s) for s in sizes}, "zz": 0})
    for s in sizes:
        assert target[s] == pytest.approx(want[s]) and abs(taken[s] - target[s]) <= 2 * largest[s] + 3


def test_mixed_rows_follow_the_copies(spark, docs):
    df = docs([(i, f"text number {i} " + "x " * (i % 9), "abcd"[i % 4]) for i in range(300)] + [(5, "same", "a")] * 3 + [(5, "other", "a"), (None, "n", None)], extra=", k bigint, d bigint, _id bigint")
    copies = Counter()
    for r in mixing.copies_table(df).collect():
        copies[r.row] += r.copies
    got = Counter(r.row for r in mixing.mix(df).withColumn("row", mixing.content_hash(df)).collect())
    assert got == +copies and mixing.mix(df).columns == df.columns


def test_one_size_one_source(spark, docs):
    """A source and a size that hold all rows: nothing meets in one window but a bucket of ids."""
    rows = mixing.mix_report(docs([(i, "a b c", "s") for i in range(3000)])).collect()
    assert sum(r.taken for r in rows) == 9000


def test_empty_table_and_no_python(spark, docs):
    assert mixing.mix_report(docs([])).count() == 0 and mixing.mix(docs([])).count() == 0
    plan = mixing.mix_report(docs([(1, "x", "s")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
