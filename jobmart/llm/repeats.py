"""Exact repeated passages: enhanced suffix arrays and their common-prefix interval trees, dealt out by anchors.

What has to meet: any two places with the same ``LENGTH``-byte string. Every such string is represented by its
leftmost smallest gram (``GRAM`` bytes, by a rolling hash), which depends on nothing but the string, so equal
strings have equal grams. One gram in about fifteen is chosen; the strings it represents at one place form a segment
of 50 to 80 bytes around it.

Documents are dealt into buckets by a hash of their id. Buckets ask directories, which are dealt by gram:

1. which grams are met in more than one bucket? (6 bytes a gram asked, one bit answered);
2. for the segments of shared grams, each different one sent once per bucket: the directory builds the suffix
   array of a gram's segments with the longest common prefixes of neighbours, scans it with a stack into the tree of
   common-prefix intervals, and keeps the intervals of 50 bytes and more whose left neighbours differ
   (maximal repeats). All occurrences of such a group are answered, each with whether a smaller doc_id has it.

A gram in very many buckets (``HOT``) is asked by single strings instead of segments, so that no directory
group holds more than one entry per bucket and different string; the number of entries of a gram is so
bounded by the number of buckets, however many documents hold it.

Texts travel compressed, one blob per input batch and bucket; a task holds one bucket (about ``BUCKET_BYTES`` of text) or one
directory (the shared segments of about ``DIRECTORY_BYTES``). Nothing
is collected to the driver but the total size. Equality is by bytes inside a directory; grams, and the strings of
hot grams, are told apart by 64-bit hashes.

Defined results: a null text is empty; a null doc_id counts as larger than any other; rows with equal doc_id do not
count as smaller than each other; texts under 50 bytes lose nothing; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobmart.llm.common import staged

LENGTH, GRAM = 50, 20
BUCKET_BYTES, DIRECTORY_BYTES = 2_000_000, 32_000_000
#: Strings handled at a time while anchors are chosen.
STEP = 1 << 18
HOT = 2000
_MULTIPLIER = 0x9E3779B97F4A7C15
_MASK48 = np.uint64((1 << 48) - 1)
_NULL = np.iinfo(np.int64).max


def _table(seed: int = 50) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


_BYTES = _table()
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, modulo 2^64."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, 1 << 16)
        for name, base in (("up", _MULTIPLIER), ("down", pow(_MULTIPLIER, -1, 1 << 64))):
            x = np.full(size, base, dtype=np.uint64)
            x[0] = 1
            _POWERS[name] = np.multiply.accumulate(x)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(29))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def sums(data: np.ndarray) -> np.ndarray:
    """Prefix sums of the polynomial hash of ``data`` (uint8)."""
    p = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTES[data] * _powers(len(data))[0], out=p[1:])
    return p


def hashes(p: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the substrings [start, end), the same wherever they stand."""
    return _mixed((p[end] - p[start]) * _powers(len(p))[1][start] + (end - start).astype(np.uint64))


def anchors(data: np.ndarray, doc: np.ndarray, p: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(gram hash, first string, last string) of every chosen gram of concatenated documents.

    ``doc`` numbers the document of every byte; strings that cross documents represent nothing. The strings
    are given by their starts, ends inclusive.
    """
    n, target = len(data) - length + 1, length - gram + 1
    grams, firsts, places, ends = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for s in range(0, n, STEP):  # a stretch of strings at a time: the working arrays are many times the text
        e = min(s + STEP, n)
        stop = e + length - 1
        at = np.arange(s, stop - gram + 1, dtype=np.int64)
        h = _mixed((p[s + gram:stop + 1] - p[s:stop - gram + 1]) * _powers(stop)[1][s:stop - gram + 1])
        value, place, width = h, at, 1
        while width < target:  # smallest of a doubling window, the leftmost where equal
            w = min(width, target - width)
            left = value[:-w] <= value[w:]
            value, place = np.where(left, value[:-w], value[w:]), np.where(left, place[:-w], place[w:])
            width += w
        inside = np.flatnonzero(doc[s:e] == doc[s + length - 1:stop])
        if len(inside):
            place = place[inside]
            new = np.flatnonzero(np.append(True, (place[1:] != place[:-1]) | (np.diff(inside) != 1)))
            firsts.append(inside[new] + s)
            ends.append(inside[np.append(new[1:], len(inside)) - 1] + s)
            places.append(place[new])
            grams.append(h[place[new] - s])
    gram_of, first, place, last = (np.concatenate(x) for x in (grams, firsts, places, ends))
    if not len(first):
        return gram_of, first, last
    # a gram's strings may go on in the next stretch
    on = np.append(False, (place[1:] == place[:-1]) & (first[1:] == last[:-1] + 1))
    begin = np.flatnonzero(~on)
    return gram_of[begin], first[begin], last[np.append(begin[1:], len(first)) - 1]


class Bucket:
    """The documents of one bucket in a fixed order, their anchors, and the different grams and segments."""

    def __init__(self, docs: list[tuple[int, int, bytes]], length: int, gram: int):
        docs.sort()
        self.length = length
        self.keys = np.array([d[0] for d in docs], dtype=np.int64)
        self.nulls = [bool(d[1]) for d in docs]
        sizes = np.array([len(d[2]) for d in docs], dtype=np.int64)
        self.starts = np.concatenate(([0], np.cumsum(sizes)))
        self.text = b"".join(d[2] for d in docs)
        docs.clear()
        data = np.frombuffer(self.text, dtype=np.uint8)
        doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        self.sums = sums(data)
        self.gram, self.first, self.last = anchors(data, doc, self.sums, length, gram)
        self.doc = doc[self.first] if len(self.first) else np.empty(0, np.int32)

    def grams(self, parts: int):
        """The different grams by directory: sorted by (directory, gram), where each directory begins, in several documents or not."""
        order = np.lexsort((self.doc, self.gram))
        g, d = self.gram[order], self.doc[order]
        new = np.append(True, g[1:] != g[:-1]) if len(g) else np.empty(0, bool)
        begin = np.flatnonzero(new)
        several = np.minimum.reduceat(d, begin) != np.maximum.reduceat(d, begin) if len(begin) else np.empty(0, bool)
        u = g[begin]
        part = (u >> np.uint64(48)) % np.uint64(parts)
        by = np.argsort(part, kind="stable")
        return u[by], np.searchsorted(part[by], np.arange(parts + 1, dtype=np.uint64)), several[by]

    def shared(self, parts: int, answers: dict[int, np.ndarray]):
        """Anchors of grams that are met elsewhere or in several documents here, and whether the gram is hot."""
        u, cuts, several = self.grams(parts)
        flags = np.zeros(len(u), dtype=np.uint8)
        for g, bits in answers.items():
            flags[cuts[g]:cuts[g + 1]] = np.frombuffer(bits, dtype=np.uint8) if len(bits) else 0
        keep = (flags > 0) | several
        order = np.argsort(u)
        at = order[np.searchsorted(u[order], self.gram)] if len(u) else np.empty(0, np.int64)
        on = keep[at] if len(u) else np.empty(0, bool)
        return np.flatnonzero(on), flags[at][on] == 2 if len(u) else np.empty(0, bool)

    def different(self, start, end, key):
        """Different strings among [start, end): representative index, inverse, smallest key, by hash order."""
        h = hashes(self.sums, start, end)
        _, rep, inverse = np.unique(h, return_index=True, return_inverse=True)
        least = np.full(len(rep), _NULL, dtype=np.int64)
        np.minimum.at(least, inverse, key)
        return h, rep, inverse, least


def prefix_length(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while high - low > 1:
        mid = (low + high) // 2
        if a[:mid] == b[:mid]:
            low = mid
        else:
            high = mid
    return low


def maximal_repeats(strings: list[bytes], length: int = LENGTH):
    """(common length, [(string, offset), ...]) for every maximal repeat of at least ``length`` bytes.

    The suffixes are sorted; neighbours' common prefixes are scanned with a stack, each popped entry being one
    interval of the tree with all its occurrences. An interval counts if it cannot be extended to the
    left in all its occurrences at once: their left neighbours differ, or one stands at a string's start.
    """
    suffixes = sorted((s[o:], i, o) for i, s in enumerate(strings) for o in range(len(s) - length + 1))
    stack, out = [], []  # (common length, first suffix)
    for at in range(1, len(suffixes) + 1):
        common = 0
        if at < len(suffixes):
            a, b = suffixes[at - 1][0], suffixes[at][0]
            if a[:length] == b[:length]:
                common = prefix_length(a, b)
        begin = at - 1
        while stack and stack[-1][0] > common:
            size, begin = stack.pop()
            places = [(i, o) for _, i, o in suffixes[begin:at]]
            left = {strings[i][o - 1] if o else -1 for i, o in places}
            if len(left) > 1 or -1 in left:
                out.append((size, places))
        if common and (not stack or stack[-1][0] < common):
            stack.append((common, begin))
    return out


def directory(entries: list[tuple[int, int, int, bytes]], length: int = LENGTH) -> list[tuple[int, int, int, int]]:
    """Entries (bucket, number there, smallest key there, segment) of one gram -> (bucket, number, offset, size) that a smaller key has."""
    least: dict[bytes, int] = {}
    for _, _, key, s in entries:
        least[s] = min(key, least.get(s, key))
    inside: dict[bytes, list] = {s: [(0, len(s), k)] for s, k in least.items()}
    if len(least) > 1:
        strings = list(least)
        for size, places in maximal_repeats(strings, length):
            k = min(least[strings[i]] for i, _ in places)
            for i, o in places:
                if k < least[strings[i]]:
                    inside[strings[i]].append((o, size, k))
    return [(b, i, o, n) for b, i, key, s in entries for o, n, k in inside[s] if k < key]


# ---- blobs

def _squeeze(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=3).compress(data)


def _expand(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(data)


def _pack_docs(batches):
    import pyarrow as pa

    for b in batches:
        bucket = b.column(0).to_numpy()
        order = np.argsort(bucket, kind="stable")
        cuts = np.append(np.flatnonzero(np.append(True, np.diff(bucket[order]) != 0)), len(order)) if len(order) else []
        ids, texts, names, blobs = b.column(1), b.column(2), [], []
        for s, e in zip(cuts, cuts[1:]):
            rows = order[s:e]
            own = ids.take(pa.array(rows))
            parts = [(texts[int(i)].as_py() or "").encode() for i in rows]
            head = [np.int64(len(rows)).tobytes(), own.fill_null(_NULL).to_numpy().astype(np.int64).tobytes(), own.is_null().cast(pa.int8()).to_numpy().tobytes(),
                    np.array([len(p) for p in parts], np.int64).tobytes()]
            names.append(int(bucket[rows[0]]))
            blobs.append(_squeeze(b"".join(head + parts)))
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array([-1] * len(names), pa.int32()), pa.array([2] * len(names), pa.int32()), pa.array(blobs, pa.binary())], ["b", "g", "kind", "blob"])


def _unpack_docs(blob: bytes, into: list) -> None:
    data = _expand(blob)
    n = int(np.frombuffer(data, np.int64, 1)[0])
    keys = np.frombuffer(data, np.int64, n, 8)
    nulls = np.frombuffer(data, np.int8, n, 8 + 8 * n)
    sizes = np.frombuffer(data, np.int64, n, 8 + 9 * n)
    at = 8 + 17 * n
    for k, z, size in zip(keys.tolist(), nulls.tolist(), sizes.tolist()):
        into.append((k, z, data[at:at + size]))
        at += size


def _groups(batches, column: int):
    """Consecutive rows with the same value in ``column``, as (value, iterator of row tuples read once)."""
    held, value, begun = [], None, False
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns)):
            if begun and row[column] != value:
                yield value, held
                held = []
            value, begun = row[column], True
            held.append(row)
    if held:
        yield value, held


_SCHEMA = "b int, g int, kind int, blob binary"


def _batch(rows):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.int32()), pa.array([r[3] for r in rows], pa.binary())], ["b", "g", "kind", "blob"])


def _load(rows, length: int, gram: int):
    docs, answers = [], {0: {}, 1: {}}
    for _, g, kind, blob in rows:
        if kind == 2:
            _unpack_docs(blob, docs)
        else:
            answers[kind][g] = blob
    return Bucket(docs, length, gram), answers


def _ask_grams(parts, length, gram):
    def run(batches):
        for b, rows in _groups(batches, 0):
            bucket, _ = _load(rows, length, gram)
            u, cuts, _ = bucket.grams(parts)
            low = (u & _MASK48).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
            yield _batch([(b, g, 0, low[cuts[g]:cuts[g + 1]].tobytes()) for g in range(parts) if cuts[g] < cuts[g + 1]])
    return run


def _answer_grams(hot):
    """A byte for every gram asked: 0 this bucket alone, 1 met in others, 2 met in more than ``hot``; all-zero answers stay away."""
    def run(batches):
        for g, rows in _groups(batches, 1):
            wide = []
            for r in rows:
                x = np.zeros((len(r[3]) // 6, 8), np.uint8)
                x[:, :6] = np.frombuffer(r[3], np.uint8).reshape(-1, 6)
                wide.append(x.view("<u8").ravel())
            _, inverse, count = np.unique(np.concatenate(wide), return_inverse=True, return_counts=True)
            flags = np.where(count > hot, 2, np.where(count > 1, 1, 0)).astype(np.uint8)[inverse]
            at, out = 0, []
            for r, w in zip(rows, wide):
                f = flags[at:at + len(w)]
                at += len(w)
                if f.any():
                    out.append((r[0], g, 0, _squeeze(f.tobytes())))
            yield _batch(out)
    return run


def _requests(bucket: Bucket, parts: int, answers: dict):
    """What the bucket sends in the second round, in a fixed order: everything needed to send it and to read the answers.

    Segments of shared grams and single strings of hot ones, each different one once: (start, end, directory, key,
    number inside its directory), and for every anchor string which request it is.
    """
    on, hot = bucket.shared(parts, {g: _expand(x) for g, x in answers.items()})
    first, last, gram, doc = bucket.first[on], bucket.last[on], bucket.gram[on], bucket.doc[on]
    cold = ~hot
    count = (last - first + 1)[hot]
    single = np.repeat(first[hot], count) + (np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count))
    start = np.concatenate((first[cold], single))
    end = np.concatenate((last[cold], single)) + bucket.length
    owner = np.concatenate((doc[cold], np.repeat(doc[hot], count)))
    is_hot = np.concatenate((np.zeros(int(cold.sum()), bool), np.ones(len(single), bool)))
    h, rep, inverse, least = bucket.different(start, end, bucket.keys[owner])
    lead = np.concatenate((gram[cold], h[int(cold.sum()):]))[rep]  # a hot string is its own directory key
    part = ((lead >> np.uint64(48)) % np.uint64(parts)).astype(np.int64)
    order = np.lexsort((h[rep], lead, part))
    return start, end, owner, inverse, rep[order], part[order], lead[order], least[order], is_hot[rep][order], np.argsort(order), least


def _ask_segments(parts, length, gram):
    def run(batches):
        for b, rows in _groups(batches, 0):
            bucket, answers = _load(rows, length, gram)
            start, end, _, _, rep, part, lead, least, hot, _, _ = _requests(bucket, parts, answers[0])
            out = []
            for g in range(parts):
                s, e = np.searchsorted(part, (g, g + 1))
                if s < e:
                    r = rep[s:e]
                    text = [b"" if z else bucket.text[x:y] for x, y, z in zip(start[r].tolist(), end[r].tolist(), hot[s:e].tolist())]
                    out.append((b, g, 1, _squeeze(b"".join([np.int64(e - s).tobytes(), lead[s:e].tobytes(), least[s:e].tobytes(), np.array([len(t) for t in text], np.uint8).tobytes(), *text]))))
            yield _batch(out)
    return run


def _answer_segments(length):
    """Per bucket: (number, offset, size) of the parts of its segments that a smaller key outside has, nine bytes each."""
    def run(batches):
        for g, rows in _groups(batches, 1):
            leads, keys, buckets, numbers, texts = [], [], [], [], []
            for b, _, _, blob in rows:
                data = _expand(blob)
                n = int(np.frombuffer(data, np.int64, 1)[0])
                leads.append(np.frombuffer(data, np.uint64, n, 8))
                keys.append(np.frombuffer(data, np.int64, n, 8 + 8 * n))
                size = np.frombuffer(data, np.uint8, n, 8 + 16 * n)
                at = 8 + 17 * n
                ends = at + np.cumsum(size.astype(np.int64))
                texts += [data[e - z:e] for e, z in zip(ends.tolist(), size.tolist())]
                buckets.append(np.full(n, b, np.int64))
                numbers.append(np.arange(n))
            lead, key, bucket, number = (np.concatenate(x) for x in (leads, keys, buckets, numbers))
            order = np.lexsort((bucket, lead))
            cuts = np.append(np.flatnonzero(np.append(True, np.diff(lead[order]) != 0)), len(order)).tolist()
            found: dict[int, list] = {}
            order, bucket, number, key = order.tolist(), bucket.tolist(), number.tolist(), key.tolist()
            for s, e in zip(cuts, cuts[1:]):
                if e - s == 1:
                    continue
                group = order[s:e]
                if texts[group[0]]:
                    hits = directory([(bucket[i], number[i], key[i], texts[i]) for i in group], length)
                else:  # strings of a hot gram: the directory key is the string
                    k = min(key[i] for i in group)
                    hits = [(bucket[i], number[i], 0, length) for i in group if k < key[i]]
                for b, i, o, n in hits:
                    found.setdefault(b, []).append((i, o, n))
            yield _batch([(b, g, 1, _squeeze(np.array(x, dtype="<u4").tobytes())) for b, x in sorted(found.items())])
    return run


def _remove(parts, length, gram):
    def run(batches):
        import pyarrow as pa

        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        for _, rows in _groups(batches, 0):
            bucket, answers = _load(rows, length, gram)
            start, end, owner, inverse, rep, part, _, _, _, place, least = _requests(bucket, parts, answers[0])
            cover = np.zeros(len(bucket.text) + 1, dtype=np.int32)
            # a smaller document of the same bucket has the whole string
            local = least[inverse] < bucket.keys[owner]
            np.add.at(cover, start[local], 1)
            np.add.at(cover, end[local], -1)
            if answers[1]:
                got = []
                for g, blob in answers[1].items():
                    x = np.frombuffer(_expand(blob), "<u4").reshape(-1, 3).astype(np.int64)
                    x[:, 0] += np.searchsorted(part, g)
                    got.append(x)
                got = np.concatenate(got)
                got = got[np.argsort(got[:, 0], kind="stable")]
                number = place[inverse]  # the request of every string
                begin, stop = np.searchsorted(got[:, 0], number), np.searchsorted(got[:, 0], number, side="right")
                count = stop - begin
                who = np.repeat(np.arange(len(number)), count)
                what = np.repeat(begin, count) + (np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count))
                a = start[who] + got[what, 1]
                np.add.at(cover, a, 1)
                np.add.at(cover, a + got[what, 2], -1)
            gone = np.cumsum(cover[:-1]) > 0
            out = []
            for i, (s, e) in enumerate(zip(bucket.starts.tolist(), bucket.starts[1:].tolist())):
                x = gone[s:e]
                removed = int(x.sum())
                text = bucket.text[s:e]
                spans = int(x[0]) + int((x[1:] & ~x[:-1]).sum()) if removed else 0
                kept = np.frombuffer(text, np.uint8)[~x].tobytes() if removed else text
                out.append((None if bucket.nulls[i] else int(bucket.keys[i]), e - s, removed, spans, hashlib.sha256(kept).hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.string() if k == 4 else pa.int64()) for k in range(5)], names)
    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, bucket_bytes: int = BUCKET_BYTES, directory_bytes: int = DIRECTORY_BYTES, hot: int = HOT) -> DataFrame:
    """One row per document: its bytes, the bytes covered by a string of ``length`` that a smaller doc_id has, their runs, a digest of the rest."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // bucket_bytes))
    parts = max(-(-size // directory_bytes), min(buckets, 32))
    blobs = docs.select(F.pmod(F.xxhash64(F.col("doc_id").cast("bigint")), F.lit(buckets)).cast("int").alias("b"), F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(_pack_docs, _SCHEMA)
    by = lambda df, key: df.repartition(key).sortWithinPartitions(key, "kind", "b", "g")
    asked = by(blobs, "b").mapInArrow(_ask_grams(parts, length, gram), _SCHEMA)
    flags = staged(by(asked, "g").mapInArrow(_answer_grams(hot), _SCHEMA), "flags")
    sent = by(blobs.unionByName(flags), "b").mapInArrow(_ask_segments(parts, length, gram), _SCHEMA)
    answers = by(sent, "g").mapInArrow(_answer_segments(length), _SCHEMA)
    return by(blobs.unionByName(flags).unionByName(answers), "b").mapInArrow(
        _remove(parts, length, gram), "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
