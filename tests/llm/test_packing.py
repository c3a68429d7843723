"""Packing: every id in exactly one piece, gapless sequences, checksums, little padding."""

import random
import zlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from jobmart.llm import packing


@pytest.fixture(scope="module")
def slow():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(P.path("byte_bpe_50k.json"))


def check(pieces, texts, slow, capacity=2048):
    ids = {i: slow.encode(t or "", add_special_tokens=False).ids + [1] for i, t in texts.items()}
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_seq[p.sequence_id].append(p)
        part = np.array(ids[p.doc_id][p.start:p.start + p.length], "<u4")
        assert p.ids_crc32 == zlib.crc32(part.tobytes()) and p.doc_tokens == len(ids[p.doc_id]) and len(part) == p.length > 0
    for i, x in ids.items():
        at = 0
        for p in sorted(by_doc[i], key=lambda p: p.start):
            assert p.start == at
            at += p.length
        assert at == len(x)
    padding = 0
    for seq in by_seq.values():
        at = 0
        for p in sorted(seq, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding


def test_pieces_cover_all_ids_without_padding(spark, docs, slow):
    r = random.Random(3)
    texts = {i: " ".join(r.choice(("alpha", "béta", "漢字", "x9", "<|endoftext|>", "\n\n")) for _ in range(r.choice((0, 3, 200, 900, 5000)))) for i in range(120)}
    texts[500], texts[501] = None, ""
    df = docs([(i, t, "s") for i, t in texts.items()], extra=", start bigint, offset bigint")
    assert check(packing.pack_public(df).collect(), texts, slow) == 0


def test_hot_length_and_empty_table(spark, docs, slow):
    same = {i: "word " * 1499 for i in range(40)}
    assert check(packing.pack_public(docs([(i, t, "s") for i, t in same.items()])).collect(), same, slow) == 0
    assert packing.pack_public(docs([])).count() == 0


def test_repeated_rows_and_null_ids(spark, docs):
    rows = packing.pack_public(docs([(None, "a b c", "s"), (None, "a b c", "s"), (4, None, "s")])).collect()
    assert sorted((r.doc_id is None, r.doc_tokens) for r in rows if r.start == 0) == [(False, 1), (True, 4), (True, 4)]


def test_both_encoders_agree(slow):
    fast = packing.Ids(P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    r = random.Random(5)
    pool = [chr(c) for c in [*range(0x250)] + [0x2028, 0x4E2D, 0x1F600, 0x0301]] + ["'s", "'ll", "  ", " \n", "<|endoftext|>", "123", "the "]
    for _ in range(400):
        text = "".join(r.choice(pool) for _ in range(r.randint(0, 60)))
        assert fast(text).tolist() == slow.encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=9), st.integers(1, 60))
def test_closest_sum_equals_brute_force(lengths, room):
    best = max(sum(c) for n in range(len(lengths) + 1) for c in combinations(lengths, n) if sum(c) <= room)
    counts = {x: lengths.count(x) for x in lengths}
    got = packing.closest(counts, room)
    assert sum(k * n for k, n in got.items()) == best and all(0 < n <= counts[k] for k, n in got.items())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 63), max_size=80))
def test_packer_small_capacity(lengths):
    p = packing.Packer(64)
    for i, x in enumerate(lengths):
        p.add(i, 0, x)
    windows = [*p.windows(0)]
    assert all(sum(x[2] for x in w) == 64 for w in windows)
    rest = [*p.rest()]
    assert all((n := sum(x[2] for x in w)) & (n - 1) == 0 for w in rest)
    seen = defaultdict(int)
    for w in windows + rest:
        for doc, start, n in w:
            seen[doc] += n
    assert dict(seen) == dict(enumerate(lengths))
