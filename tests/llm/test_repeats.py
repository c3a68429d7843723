"""Repeated passages against brute force over all 50-byte strings; maximal repeats; hot grams; skewed copies."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from jobmart.llm import repeats


def brute(rows, n=50):
    largest, first = 2 ** 63 - 1, {}
    key = lambda d: largest if d is None else d
    for d, t in sorted((key(d), (t or "").encode()) for d, t in rows):
        for i in range(len(t) - n + 1):
            first.setdefault(t[i:i + n], d)
    out = []
    for d, t in rows:
        t = (t or "").encode()
        gone = [False] * len(t)
        for i in range(len(t) - n + 1):
            if first[t[i:i + n]] < key(d):
                gone[i:i + n] = [True] * n
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(t), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(t, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def rows_of(seed=1, n=80):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 5)))
    passages = [" ".join(word() for _ in range(r.choice((9, 14, 40, 200)))) for _ in range(8)]
    passages += ["x" * 130, "ab" * 60]
    rows = [(r.choice((i, i, i, i // 2)), " ".join(r.choice(passages) if r.random() < 0.4 else " ".join(word() for _ in range(20)) for _ in range(r.randint(0, 4)))) for i in range(n)]
    return rows + [(None, passages[0]), (None, passages[0] + passages[1]), (-5, passages[2]), (500, None), (501, ""), (502, "y" * 49), (503, "y" * 50), (504, "y" * 51)]


@pytest.mark.parametrize("options", [{}, {"bucket_bytes": 2000}, {"bucket_bytes": 2000, "hot": 1}, {"bucket_bytes": 800, "gram": 32}])
def test_equals_brute_force(spark, docs, options):
    rows = rows_of()
    got = repeats.remove_repeats(docs([(d, t, "s") for d, t in rows], extra=", b bigint, g bigint, kind bigint"), **options).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_group_of_copies_and_common_passage(spark, docs):
    common = "This passage of well over fifty bytes stands in every one of the documents of the table."
    r = random.Random(8)
    rows = [(i, "".join(r.choice("abcdefgh ") for _ in range(80)) + common + "".join(r.choice("abcdefgh ") for _ in range(60))) for i in range(200)] + [(1000 + i, rows_text) for i, rows_text in enumerate(["exact copy " * 30] * 150)]
    for options in ({"bucket_bytes": 3000}, {"bucket_bytes": 3000, "hot": 5}):
        got = repeats.remove_repeats(docs([(d, t, "s") for d, t in rows]), **options).collect()
        assert sorted((tuple(x) for x in got), key=str) == brute(rows)


def test_empty_table(spark, docs):
    assert repeats.remove_repeats(docs([])).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="ab", min_size=0, max_size=14).map(str.encode), max_size=5))
def test_maximal_repeats_equal_brute_force(strings):
    n = 3
    places: dict[bytes, list] = {}
    for i, s in enumerate(strings):
        for o in range(len(s)):
            for e in range(o + n, len(s) + 1):
                places.setdefault(s[o:e], []).append((i, o))
    want = set()
    for text, at in places.items():
        left = {strings[i][o - 1] if o else None for i, o in at}
        right = {strings[i][o + len(text)] if o + len(text) < len(strings[i]) else None for i, o in at}
        if len(at) > 1 and (len(left) > 1 or None in left) and (len(right) > 1 or None in right):
            want.add((len(text), tuple(sorted(at))))
    assert {(size, tuple(sorted(at))) for size, at in repeats.maximal_repeats(strings, n)} == want


def test_anchors_in_stretches(monkeypatch):
    r = np.random.default_rng(6)
    data = r.integers(97, 99, 5000, dtype=np.uint8)
    doc = np.sort(r.integers(0, 20, 5000)).astype(np.int32)
    whole = repeats.anchors(data, doc, repeats.sums(data))
    monkeypatch.setattr(repeats, "STEP", 97)
    assert all((a == b).all() for a, b in zip(whole, repeats.anchors(data, doc, repeats.sums(data))))


def test_anchors_depend_on_the_string_only():
    r = np.random.default_rng(2)
    middle = r.integers(97, 101, 300, dtype=np.uint8)
    for seed in range(5):
        side = np.random.default_rng(seed).integers(97, 101, (2, 70), dtype=np.uint8)
        data = np.concatenate((side[0], middle, side[1]))
        gram, first, last = repeats.anchors(data, np.zeros(len(data), np.int32), repeats.sums(data))
        assert (first[1:] == last[:-1] + 1).all() and first[0] == 0 and last[-1] == len(data) - 50
        of = {i - 70: g for g, a, b in zip(gram.tolist(), first.tolist(), last.tolist()) for i in range(a, b + 1) if 0 <= i - 70 <= 250}
        assert seed == 0 or of == before
        before = of
