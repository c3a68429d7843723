"""Personal data: candidate spans, boosted trees over format and context, calibrated thresholds.

Three layers, all inside one narrow pass over the texts (no shuffle):

1. the four fixed kinds (email, ip, card, phone) by their patterns and checks; these always stay;
2. high-recall generators propose further, overlapping spans (digit groups, written-out mail addresses, bank
   and network addresses, long mixed tokens) in the text between the fixed ones: the widest match and what
   its separators bound inside it;
3. boosted trees score every proposal by its own format and the words around it. Probabilities are
   calibrated on held-out rows, and each kind's threshold is the smallest that keeps its held-out precision.
   Where proposals overlap, the more probable one is taken, the longer one of equals; none replaces a fixed kind.

The trees are fitted on the driver from ``TRAIN_ROWS`` generated, labelled snippets (a fixed bound, a fixed
seed); the texts themselves are only scored, whole, in the tasks.

Defined results: a null or empty text has no spans; repeated rows are judged each on its own; an empty
table gives an empty table. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from bisect import bisect_left
from functools import lru_cache
from itertools import islice

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobmart.llm.boost import Boosted

BASE = ("email", "ip", "card", "phone")
TRAIN_ROWS, SEED, PRECISION = 6000, 11, 0.99

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: One attempt per run of digits: where the run's start fails, so does every later start in it.
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def emails(text: str):
    """Leftmost non-overlapping mail addresses: one attempt per @, from the start of the run before it."""
    free = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            yield start, m.end()
            free = m.end()
        at = text.find("@", max(free, at + 1))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """The fixed kinds: (start, end, kind); matches that fail their check are dropped without a retry."""
    out = [(s, e, "email") for s, e in emails(text)]
    for m in _IP.finditer(text):
        if all(int(p) <= 255 for p in (x.lstrip("0")[:4] or "0" for x in m[0].split("."))):
            out.append((m.start(), m.end(), "ip"))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), m.end(), "card"))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((m.start(), m.end(), "phone"))
    order = {k: i for i, k in enumerate(BASE)}
    return sorted(out, key=lambda s: (s[0], order[s[2]]))


#: Generators: wide on purpose, the trees decide.
GENERATORS = {
    "number": re.compile(r"\(?[0-9][0-9 ().-]{5,}[0-9]"),
    "secret": re.compile(r"[A-Za-z0-9_+/=-]{20,}"),
    "iban": re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"),
    "ipv6": re.compile(r"(?=[0-9A-Fa-f:]{0,34}::)(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6}::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?|::[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})|(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}"),
    "mail_words": re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+ ?(?:\[at\]|\(at\)| at ) ?[A-Za-z0-9-]+(?: ?(?:\[dot\]|\(dot\)| dot ) ?[A-Za-z]{2,})+"),
}
KINDS = tuple(GENERATORS)
_NEED = {"iban": re.compile(r"[A-Z]{2}[0-9]{2}"), "ipv6": re.compile(r"[0-9A-Fa-f]:[0-9A-Fa-f:]|::[0-9A-Fa-f]"), "mail_words": re.compile(r"[\[( ]dot[\]) ]")}
_CONTEXT = {
    "phone": re.compile(r"phone|tel|call|mobile|fax|whatsapp|telefon|anruf|appel|llam", re.I),
    "id": re.compile(r"ssn|social|passport|account|konto|iban|steuer|ausweis|carte|cuenta|bank", re.I),
    "secret": re.compile(r"token|secret|passw|api|key|auth|bearer|pwd|credential", re.I),
    "mail": re.compile(r"mail|contact|write|reach", re.I),
    "net": re.compile(r"addr|host|server|client|from|login", re.I),
    "plain": re.compile(r"order|invoice|version|isbn|article|total|price|date|page|ref|build|chapter|no\.|nr", re.I),
}
_SHAPES = {name: re.compile(p) for name, p in {
    "national": r"\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}", "social": r"[0-9]{3}-[0-9]{2}-[0-9]{4}", "hex": r"[0-9a-fA-F-]+",
    "date": r".*(?:19|20)[0-9]{2}[-./ ][0-9]{1,2}[-./ ][0-9]{1,2}.*|.*[0-9]{1,2}[./-][0-9]{1,2}[./-](?:19|20)[0-9]{2}.*", "clock": r"(?:[0-9]{1,2}:)+[0-9]{1,2}"}.items()}

#: A number of these shapes, and what joins the parts of one number or address.
_WITHIN = re.compile(rf"(?<![0-9])(?:{_SHAPES['national'].pattern}|{_SHAPES['social'].pattern})(?![0-9])")
_JOINS = ("-", ".", "/", ":")

#: No personal number has more digits than the longest card; wider sub-spans only join several.
_DIGITS = 19
_GROUP = re.compile(r"[0-9]+")
_BANK = re.compile(f"(?=({GENERATORS['iban'].pattern}))")
_DOT = re.compile(r" ?(?:\[dot\]|\(dot\)| dot ) ?[A-Za-z]{2,}")


def _inside(text: str, start: int, end: int, kind: str):
    """What the separators in a generator's match bound; linear in its length."""
    if kind == "number":
        groups = [(m.start(), m.end()) for m in _GROUP.finditer(text, start, end)]
        for i, (a, _) in enumerate(groups):
            at, digits = a - (a > start and text[a - 1] == "("), 0
            for c, d in groups[i:]:
                digits += d - c
                if digits > _DIGITS:
                    break
                if d - at >= 7:
                    yield at, d
    elif kind == "secret":
        for mark in "=/+-_":
            at = start
            for piece in text[start:end].split(mark):
                if len(piece) >= 20:
                    yield at, at + len(piece)
                at += len(piece) + 1
    elif kind == "mail_words":
        for m in _DOT.finditer(text, start, end):
            yield start, m.end()


def _gaps(size: int, base):
    """The stretches of the text outside the base spans, which are sorted by start."""
    at = 0
    for start, end, _ in base:
        if start > at:
            yield at, start
        at = max(at, end)
    if at < size:
        yield at, size


def proposals(text: str, base=()):
    """Spans that overlap no base span, but each other."""
    for kind, pattern in GENERATORS.items():
        need = _NEED.get(kind)
        if need is not None and not need.search(text):
            continue
        for a, b in _gaps(len(text), base):
            if kind == "iban":
                for m in _BANK.finditer(text, a, b):
                    start, end = m.span(1)
                    yield start, end, kind
                    yield from ((start, e, kind) for e in range(start + 15, end) if text[e] == " ")
                continue
            for m in pattern.finditer(text, a, b):
                yield *m.span(), kind
                yield from ((x, y, kind) for x, y in _inside(text, *m.span(), kind) if (x, y) != m.span())


def _iban_ok(s: str) -> bool:
    s = s.replace(" ", "")
    if not 15 <= len(s) <= 34:
        return False
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def features(text: str, start: int, end: int, kind: str) -> list[float]:
    """Format of the span, then the context before and after it."""
    s, n = text[start:end], end - start
    before, after = text[max(0, start - 30):start], text[end:end + 10]
    digits, lower, upper = (sum(f(c) for c in s) for f in (str.isdigit, str.islower, str.isupper))
    marks = len(s) - digits - lower - upper
    counts = [s.count(c) for c in set(s)]
    entropy = -sum(c / len(s) * math.log2(c / len(s)) for c in counts)
    turns = sum(a.isdigit() != b.isdigit() for a, b in zip(s, s[1:]))
    return [KINDS.index(kind), n, digits, lower, upper, marks, digits / len(s), entropy, turns,
            max((len(g) for g in re.findall("[0-9]+", s)), default=0), s.count("-"), s.count("."), s.count(" "), s.count(":"), s.count("="),
            *[float(bool(p.fullmatch(s))) for p in _SHAPES.values()],
            float(kind == "iban" and _iban_ok(s)), float(kind == "number" and luhn("".join(c for c in s if c in "0123456789"))),
            float(kind == "number" and any((m.start(), m.end()) != (0, n) for m in _WITHIN.finditer(s))),
            *[float(bool(p.search(before))) for p in _CONTEXT.values()],
            float(before[-1:] in _JOINS and before[-2:-1].isalnum() or before[-2:] == "::"), float(before[-1:] == " " and before[-2:-1].isdigit()),
            float(after[:1] in _JOINS and after[1:2].isalnum()), float(after[:1] == " " and after[1:2].isdigit()),
            float(before[-1:].isalnum() or before[-1:] in ("#", "/", ".", ",")), float(before.rstrip()[-1:] in ("=", ":", '"')),
            float(after[:1].isalnum() or after[:1] in ("%", "/"))]


def labelled(rows: int, seed: int) -> list[tuple[str, int, int, str, int]]:
    """Generated snippets with one marked span each: (text, start, end, kind, label).

    Besides whole spans there are spans beside others (good) and, as generators propose them, joined and cut ones (bad).
    """
    r = random.Random(seed)
    d = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    word = lambda: "".join(r.choice(("ba", "re", "ti", "on", "le", "ma", "st", "er", "ou", "en", "di", "ka")) for _ in range(r.randint(1, 4)))
    hexes = lambda n: "".join(r.choice("0123456789abcdef") for _ in range(n))
    mixed = lambda n: "".join(r.choice("abcdefghijkmnpqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789") for _ in range(n))
    sep = lambda: r.choice(" -.")

    def iban():
        head, body = r.choice((("DE", d(18)), ("ES", d(20)), ("NL", "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ") for _ in range(4)) + d(10)), ("FR", d(23))))
        return f"{head}{98 - int(''.join(str(int(c, 36)) for c in body + head + '00')) % 97:02d}{body}"

    def spaced(code):
        return " ".join(code[i:i + 4] for i in range(0, len(code), 4))

    def short():
        left, right = r.randint(1, 4), r.randint(1, 3)
        return ":".join(hexes(r.randint(2, 4)) for _ in range(left)) + "::" + ":".join(hexes(r.randint(1, 4)) for _ in range(right))

    def card():
        body = d(15)
        return body + next(c for c in "0123456789" if luhn(body + c))

    def table():
        """Groups that happen to pass the check of cards."""
        while True:
            groups = [d(r.choice((1, 2, 2, 3, 3, 5))) for _ in range(r.randint(4, 12))]
            if 14 <= sum(map(len, groups)) <= 19 and luhn("".join(groups)):
                return " ".join(groups)

    def social():
        return f"{d(3)}-{d(2)}-{d(4)}"

    def near():
        return r.choice((social, lambda: national(sep()), lambda: d(r.randint(1, 4)), lambda: f"20{d(2)}-0{r.randint(1, 9)}-{r.randint(10, 28)}", lambda: ".".join(str(r.randint(1, 255)) for _ in range(4))))()

    def beside(lead, one):
        """A number with others before or after it."""
        gap, after = r.choice((" ", " ", ". ")), r.random() < 0.6
        return (lead, one, gap + near()) if after else (lead + near() + " ", one, r.choice(("", " " + near())))

    def joined_or_cut(lead, one):
        """What separators bound in such text, but more or less than one number."""
        cuts = [i for i, c in enumerate(one) if c in " .-" and i]
        k = r.choice(cuts)
        other = near()
        return r.choice((
            (lead, f"{one}{r.choice((' ', ' ', '. '))}{other}", ""), (lead, f"{other} {one}", ""), (lead, f"{one[k + 1:]} {other}", ""),
            (lead + one[:k + 1], one[k + 1:], ""), (lead, one[:k], one[k:]), (lead + one[:k + 1], f"{one[k + 1:]} {other}", ""),
            (lead, f"{other} {one[:k]}", one[k:])))

    def national(s):
        return r.choice((f"({d(3)}) {d(3)}-{d(4)}", f"{d(3)}{s}{d(3)}{s}{d(4)}"))

    good = {
        "number": lambda: (r.choice(("tel: ", "phone ", "call ", "mobile ", "fax ", "Telefon ", "")), national(sep())),
        "number2": lambda: (r.choice(("SSN ", "social ", "ssn: ", "passport ", "")), social()),
        "number3": lambda: beside(r.choice(("tel: ", "phone ", "call ", "room ", "from ", "")), national(sep())),
        "number4": lambda: beside(r.choice(("SSN ", "social ", "ssn: ", "passport ", "")), social()),
        "number5": lambda: r.choice((lambda c, o: ("card ", c, f" {o}"), lambda c, o: ("", c, f" {c}"), lambda c, o: (f"{o} ", c), lambda c, o: (f"{c} ", c)))(r.choice((str, str, spaced))(card()), r.choice((card(), d(4)))),
        "secret": lambda: (r.choice(('token = "', "key: ", "password=", 'secret = "', "Bearer ", "api_key=", "")), r.choice((hexes(32), hexes(40), mixed(24), mixed(36)))),
        "iban": lambda: (r.choice(("IBAN ", "account ", "Konto ", "")), iban()),
        "iban2": lambda: (r.choice(("IBAN ", "account ", "Konto ", "")), r.choice((str, spaced))(iban()), r.choice(("", f" {word()[:4].upper()}", f" {d(4)}"))),
        "ipv6": lambda: (r.choice(("host ", "from ", "addr ", "")), ":".join(hexes(4) for _ in range(8))),
        "ipv62": lambda: (r.choice(("host ", "from ", "addr ", "")), short()),
        "mail_words": lambda: (r.choice(("mail ", "contact ", "")), f"{word()}.{word()}{r.choice((' at ', ' [at] ', '(at)'))}{word()}{r.choice((' dot ', ' [dot] ', '(dot)'))}{r.choice(('com', 'org', 'net'))}"),
    }
    bad = {
        "number": lambda: (r.choice(("order ", "on ", "total ", "isbn ", "page ", "from ", "")), r.choice((
            f"20{d(2)}-{r.randint(1, 12):02d}-{r.randint(1, 28):02d}", f"{r.randint(1, 28)}.{r.randint(1, 12)}.20{d(2)}", f"978-{d(1)}-{d(2)}-{d(6)}-{d(1)}", d(r.randint(7, 19)),
            f"{d(1)}.{d(1)}.{d(2)}.{d(4)}", f"{d(1)} {d(3)} {d(3)}.{d(2)}", f"{d(2)}.{d(2)}.{d(3)}.{d(2)}", f"19{d(2)}-20{d(2)}", f"{d(3)} {d(3)} {d(3)} {d(3)} {d(3)}"))),
        "number2": lambda: joined_or_cut(r.choice(("tel: ", "phone ", "call ", "room ", "from ", "")), national(sep())),
        "number3": lambda: joined_or_cut(r.choice(("SSN ", "social ", "ssn: ", "passport ", "")), social()),
        "number5": lambda: (r.choice(("", f"{d(2)} ", f"{d(3)} ")), table(), r.choice(("", f" {d(2)}", f" {d(3)}"))),
        "number4": lambda: r.choice((
            ("isbn 978-", f"{d(1)}-{d(2)}-{d(6)}", f"-{d(1)}"), ("isbn ", f"978-{d(1)}-{d(2)}-{d(6)}", f"-{d(1)}"), ("on ", f"20{d(2)}-0{d(1)}-{d(2)} {d(2)}", f":{d(2)}"), ("", f"{d(16)} {d(16)}"),
            (f"part {d(2)}-", national("-"), f"-{d(2)}"), (f"{d(4)} ", f"{d(4)} {d(4)}", f" {d(4)}"), ("total ", f"{d(3)} {d(3)}.{d(2)} {d(2)} {d(3)}", f" {d(3)}.{d(2)}"), ("", f"{d(3)} {d(3)}", f".{d(2)}"))),
        "secret2": lambda: (r.choice(("the ", "", "with ")), f"{r.choice(('token', 'password', 'key', 'api_key', 'secret'))}={r.choice((hexes(32), hexes(40), mixed(24), mixed(36)))}"),
        "secret": lambda: (r.choice(("the ", "see ", "", "chapter ")), r.choice(("".join(word() for _ in range(9))[:40].ljust(20, "a"), "-".join(word() for _ in range(6)).ljust(20, "-"),
                                                                               "=" * 24, "-" * 30, "_".join(word() for _ in range(7)).ljust(20, "_"), "/".join(word() for _ in range(7)).ljust(20, "/"), d(r.randint(20, 30)), word().capitalize() * 8 + "aaaaaaaaaaaa"))),
        "iban": lambda: (r.choice(("part ", "ref ", "order ", "")), f"{r.choice(('AB', 'XK', 'SN'))}{d(2)}{d(16)}"),
        "iban2": lambda: r.choice((lambda c: ("IBAN ", f"{c} {word()[:4].upper().ljust(4, 'A')}"), lambda c: ("IBAN ", spaced(c)[:19], spaced(c)[19:]), lambda c: ("ref " + mixed(3), f"AB{c[2:]}")))(iban()),
        "ipv62": lambda: r.choice((("st", "d::", "vector"), (word().capitalize() + "o", "::ba", "r"), ("scope ", f"{r.choice('abcdef')}::{r.choice('abcdef')}"), (word() + "o", f"::{r.choice(('add', 'be', 'dec', 'face', 'f'))}"),
            (f"from {hexes(4)}::", ":".join(hexes(4) for _ in range(4))), (f"{word()}n", f"::{r.choice(('de', 'fa', 'c'))}", word()))),
        "ipv6": lambda: (r.choice(("at ", "date ", "")), ":".join(f"{r.randint(0, 59):02d}" for _ in range(r.choice((4, 5))))),
        "mail_words": lambda: (r.choice(("she ", "we ", "")), f"{word()} at {word()} dot {word()}"),
    }
    out = []
    for i in range(rows):
        label = i % 2
        pool = good if label else bad
        kind = r.choice(list(pool))
        lead, s, *tail = pool[kind]()
        left = " ".join(word() for _ in range(r.randint(2, 6))) + " " + lead
        out.append((f"{left}{s}{''.join(tail)} {word()} {word()}", len(left), len(left) + len(s), kind.rstrip("2345"), label))
    return out


@lru_cache(1)
def fitted(rows: int = TRAIN_ROWS, seed: int = SEED, precision: float = PRECISION):
    """The trees and a threshold per kind: the smallest that keeps ``precision`` on the held-out third."""
    data = labelled(rows, seed)
    x, y = np.array([features(*row[:4]) for row in data]), np.array([row[4] for row in data], float)
    cut = rows * 2 // 3
    model = Boosted().fit(x[:cut], y[:cut], x[cut:], y[cut:])
    p, limits = model.probability(x[cut:]), {}
    for k, kind in enumerate(KINDS):
        own = x[cut:, 0] == k
        order = np.argsort(-p[own], kind="stable")
        hits = np.cumsum(y[cut:][own][order]) / np.arange(1, own.sum() + 1)
        ok = np.flatnonzero(hits >= precision)
        limits[kind] = max(0.6, float(p[own][order][ok[-1]])) if len(ok) else 1.1
    return model, limits


def find(texts: list[str], model, limits, rows: int = 8192) -> list[tuple[list, list]]:
    """(base spans, all spans) of every text, each sorted by start, then kind as listed. ``rows`` proposals are scored at a time."""
    base = [base_spans(t) for t in texts]
    found = ((i, s) for i, t in enumerate(texts) for s in proposals(t, base[i]))
    good: list[list] = [[] for _ in texts]
    while part := list(islice(found, rows)):
        for q, (i, s) in zip(model.probability(np.array([features(texts[i], *s) for i, s in part])), part):
            if q >= limits[s[2]]:
                good[i].append((-q, s[0], -s[1], s))
    extra: list[list] = [[] for _ in texts]
    for own, taken in zip(good, extra):
        for *_, s in sorted(own):
            at = bisect_left(taken, s)
            if (at == 0 or taken[at - 1][1] <= s[0]) and (at == len(taken) or taken[at][0] >= s[1]):
                taken.insert(at, s)
    order = {k: i for i, k in enumerate((*BASE, *KINDS))}
    return [(b, sorted(b + e, key=lambda s: (s[0], order[s[2]]))) for b, e in zip(base, extra)]


def joined(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def redact(text: str, spans) -> str:
    """Spans replaced by their kind in angle brackets; overlapping spans become one, named after the first."""
    out, at, i = [], 0, 0
    while i < len(spans):
        start, end, kind = spans[i]
        while i + 1 < len(spans) and spans[i + 1][0] < end:
            i += 1
            end = max(end, spans[i][1])
        out += [text[at:start], f"<{kind.upper()}>"]
        at, i = end, i + 1
    return "".join(out) + text[at:]


def _chunks(batches, rows: int = 512):
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def detect(docs: DataFrame) -> DataFrame:
    """One row per document: base counts and digest, all spans."""
    model, limits = fitted()

    def run(batches):
        import pyarrow as pa

        for b in _chunks(batches):
            texts = [t or "" for t in b.column(1).to_pylist()]
            rows = find(texts, model, limits)
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column(0),
                **{f"n_{k}": pa.array([sum(s[2] == k for s in base) for base, _ in rows], pa.int64()) for k in BASE},
                "base_sha256": [hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in rows],
                "spans": [joined(every) for _, every in rows]})

    return docs.select(docs["doc_id"].cast("bigint"), docs["text"].cast("string")).mapInArrow(
        run, "doc_id bigint, " + ", ".join(f"n_{k} bigint" for k in BASE) + ", base_sha256 string, spans string")


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data replaced in ``text`` (null stays null); other columns as they were.

    ``n_chars``, where present, is set to the new length.
    """
    model, limits = fitted()

    @F.pandas_udf("string")
    def clean(texts):
        out = texts.copy()
        for i in range(0, len(texts), 512):
            part = [t or "" for t in texts.iloc[i:i + 512]]
            out.iloc[i:i + 512] = [redact(t, every) if every else t for t, (_, every) in zip(part, find(part, model, limits))]
        return out.where(texts.notna(), None)

    d = docs.withColumn("text", clean("text"))
    return d.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else d
