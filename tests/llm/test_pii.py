"""Personal data: base spans against plain patterns, held-out accuracy of the trees, redaction."""

import hashlib
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from jobmart.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain(text):
    out = []
    for i, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True,
                  "card": 14 <= len(digits) <= 19 and pii.luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]
            if ok:
                out.append((m.start(), i, m.end(), kind))
    return [(s, e, k) for s, _, e, k in sorted(out)]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="a.b@-+%_ 0123456789()é\n", max_size=60))
def test_base_spans_equal_the_plain_patterns(text):
    assert pii.base_spans(text) == plain(text)


def test_luhn():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_trees_on_held_out_rows():
    model, limits = pii.fitted()
    data = pii.labelled(1500, 999)
    x, y = np.array([pii.features(*r[:4]) for r in data]), np.array([r[4] for r in data])
    hit = model.probability(x) >= np.array([limits[r[3]] for r in data])
    assert (hit & (y == 1)).sum() / hit.sum() > 0.97 and (hit & (y == 1)).sum() / y.sum() > 0.85


def test_query_rows_and_added_spans(spark, docs):
    token = 'key: token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" end'
    rows = [(1, "mail a.b@c.example.com or 10.0.0.1, card 4111 1111 1111 1111, call +1 (017) 555-7713.", "s"), (2, token, "s"), (3, None, "s"), (4, "", "s"), (5, "plain words only, nothing else", "s"), (5, "plain words only, nothing else", "s")]
    got = {}
    for r in pii.detect(docs(rows)).collect():
        got.setdefault(r.doc_id, []).append(r)
    a = got[1][0]
    assert (a.n_email, a.n_ip, a.n_card, a.n_phone) == (1, 1, 1, 1)
    base = ",".join(f"{k}:{s}:{e}" for s, e, k in plain(rows[0][1]))
    assert a.base_sha256 == hashlib.sha256(base.encode()).hexdigest() and set(base.split(",")) <= set(a.spans.split(","))
    assert got[2][0].spans.startswith("secret:14:54")
    assert all(got[i][0].spans == "" and got[i][0].base_sha256 == hashlib.sha256(b"").hexdigest() for i in (3, 4, 5)) and len(got[5]) == 2


def test_redaction_keeps_the_rest(spark, docs):
    df = docs([(1, "to a@b.example.com now", "s"), (2, None, "s"), (3, "clean", "s")], extra=", spans bigint, _q bigint")
    out = {r.doc_id: r for r in pii.redacted(df).collect()}
    assert out[1].text == "to <EMAIL> now" and out[1].n_chars == len(out[1].text) and out[1].spans == 7
    assert out[2].text is None and out[3].text == "clean" and out[3].n_chars == 5
    assert pii.redacted(docs([])).count() == 0 and pii.detect(docs([])).count() == 0


@pytest.mark.parametrize("text, want", [
    ("call 555-123-4567 555-987-6543 now", ["number 555-123-4567", "number 555-987-6543"]),
    ("call 415 555 2671 415 555 2672 now", ["number 415 555 2671", "number 415 555 2672"]),
    ("SSN 078-05-1120 219-09-9999 on file", ["number 078-05-1120", "number 219-09-9999"]),
    ("room 12 555-123-4567 ok", ["number 555-123-4567"]),
    ("call 555-123-4567. 2024 was good", ["number 555-123-4567"]),
    ("from 10.0.0.1 555-123-4567 ok", ["ip 10.0.0.1", "number 555-123-4567"]),
    ("call 555-123-4567 10.0.0.1 ok", ["number 555-123-4567", "ip 10.0.0.1"]),
    ("paid 4465758382889437 4465758382889437 so", ["number 4465758382889437"] * 2),
    ("IBAN ES9121000418450200051332 BBVA ok", ["iban ES9121000418450200051332"]),
    ("IBAN DE89 3704 0044 0532 0130 00 BANK ok", ["iban DE89 3704 0044 0532 0130 00"]),
    ("host 2001:db8::1 up", ["ipv6 2001:db8::1"]), ("addr fe80::1ff:fe23:4567:890a end", ["ipv6 fe80::1ff:fe23:4567:890a"]),
    ("password=04dbebab91ab85687d33eeaaf9ac699e1188f962 ok", ["secret 04dbebab91ab85687d33eeaaf9ac699e1188f962"]),
    ("use std::vector and Foo::bar on 2024-01-15 10:30 we", []), ("isbn 978-1-23-456789-0 1999", []), ("order 1234567 7654321", []),
])
def test_spans_beside_others(text, want):
    assert [f"{k} {text[s:e]}" for s, e, k in pii.find([text], *pii.fitted())[0][1]] == want


def test_proposals_overlap_each_other_and_no_base_span():
    text = "10.0.0.1 555-123-4567 555-987-6543 a@b.example.com/" + "04dbebab91ab85687d33" * 2
    base = pii.base_spans(text)
    got = list(pii.proposals(text, base))
    assert {(9, 21, "number"), (22, 34, "number"), (9, 34, "number")} <= set(got) and len(got) == len(set(got))
    assert all(e <= a or s >= b for s, e, _ in got for a, b, _ in base)


def test_many_digit_groups():
    text = " ".join(str(i % 10) for i in range(4_000))
    spans = pii.find([text], *pii.fitted())[0][1]
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:])) and sum(e - s for s, e, _ in spans) < len(text) / 20


def test_overlapping_spans_become_one():
    assert pii.redact("abcdefgh", [(1, 4, "phone"), (3, 6, "card")]) == "a<PHONE>gh"


@pytest.mark.parametrize("text", ["9" * 1_000_000, "x" * 1_000_000 + " dot com", "1." * 500_000, "x at y dot " * 50_000, "a" * 999_999 + "@"])
def test_long_runs_take_linear_time(text):
    model = pii.fitted()
    began = time.process_time()
    pii.find([text], *model)
    assert time.process_time() - began < 30


def test_addresses_beside_digits():
    kinds = lambda t: [t[s:e] for s, e, k in pii.base_spans(t) if k == "ip"]
    assert kinds("1.2.3.4.5.6.7.8 x9.8.7.6 999.1.1.1 1.1.1.1.") == ["1.2.3.4", "5.6.7.8", "9.8.7.6", "1.1.1.1"]


def test_long_text(spark, docs):
    text = "x" * 300_000 + " a@b.example.com " + "9" * 50_000
    assert pii.detect(docs([(1, text, "s")])).collect()[0].n_email == 1
