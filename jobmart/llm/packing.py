"""Packing documents into fixed-length training sequences by minimum bin slack.

Every task packs the documents of its own partition, so there is no shuffle and a lost executor costs one
partition. Full windows are cut from long documents as they come; what remains of each document (less than a
window) goes into a pool. When the pool is large enough, windows are filled one after another: the largest
remaining length opens the window, and a bitset subset-sum over the pool's length counts finds the
multiset of other lengths that comes closest to the capacity (bit i of the set: i tokens can be reached;
counts enter by binary splitting; backtracking over the stored sets gives how many of each length).
Where no multiset fits exactly, a remaining piece is cut to close the gap. What is left at the end of a
partition (less than one window) becomes sequences whose lengths are powers of two, which need no padding.

Memory per task: one input batch plus the pool, ``pool_high`` remainders of less than ``capacity`` ids.

Defined results: a null text is empty and has the end id only; repeated rows are packed each on its own; an empty
table gives no pieces; columns other than the id and the text are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import count

from pyspark.sql import DataFrame

CAPACITY = 2048
END_ID = 1
POOL_HIGH, POOL_LOW = 4096, 1024
SCHEMA = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
#: Letters and numbers outside these are classified by each library's own Unicode tables.
_FAR = re.compile("[^\x00-ɏ]")


class Ids:
    """Token ids as unsigned 32-bit arrays, by the vocabulary file of the tokenizers library.

    With ``ranks_path`` (the same vocabulary as byte-pair ranks) texts of Latin letters go through the
    faster encoder of the tiktoken library, which gives the same ids (tested); all others, and
    everything where no ranks are given, go through tokenizers itself.
    """

    def __init__(self, vocab_path: str, ranks_path: str | None = None, pattern: str | None = None):
        import base64

        from tokenizers import Tokenizer

        self.slow, self.fast = Tokenizer.from_file(vocab_path), None
        special = {t.content: i for i, t in self.slow.get_added_tokens_decoder().items() if t.special}
        if ranks_path:
            import tiktoken

            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)

    def __call__(self, text: str):
        import numpy as np

        if self.fast is not None and not _FAR.search(text):
            return self.fast.encode_to_numpy(text, allowed_special="all").astype("<u4")
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype="<u4")


def closest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of ``counts`` (length -> how many) whose sum comes closest to ``room`` without passing it."""
    reach, steps, mask = 1, [], (1 << (room + 1)) - 1
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, k = min(counts[length], room // length), 1
        while left:
            k = min(k, left)
            steps.append((length, k, reach))
            reach |= (reach << (length * k)) & mask
            left, k = left - k, k * 2
        if reach >> room:
            break
    at, chosen = reach.bit_length() - 1, {}
    for length, k, before in reversed(steps):
        if not before >> at & 1:
            at -= length * k
            chosen[length] = chosen.get(length, 0) + k
    return chosen


class Packer:
    """Pools remainders and fills windows; pieces are (document, start, length)."""

    def __init__(self, capacity: int = CAPACITY):
        self.capacity, self.pool, self.size, self.tokens = capacity, {}, 0, 0

    def add(self, doc, start: int, length: int) -> None:
        self.pool.setdefault(length, []).append((doc, start, length))
        self.size += 1
        self.tokens += length

    def take(self, length: int):
        have = self.pool[length]
        piece = have.pop()
        if not have:
            del self.pool[length]
        self.size -= 1
        self.tokens -= length
        return piece

    def windows(self, down_to: int) -> Iterator[list]:
        """Filled windows until the pool has ``down_to`` pieces, or less than one window is left."""
        while self.tokens >= self.capacity and self.size > down_to:
            seed = max(self.pool)
            counts = {k: len(v) for k, v in self.pool.items()}
            counts[seed] -= 1
            chosen = closest({k: n for k, n in counts.items() if n}, self.capacity - seed)
            used = seed + sum(k * n for k, n in chosen.items())
            chosen[seed] = chosen.get(seed, 0) + 1
            for _ in range(min(len(self.pool[k]) // n for k, n in chosen.items())):
                window = [self.take(k) for k in sorted(chosen, reverse=True) for _ in range(chosen[k])]
                gap = self.capacity - used
                while gap and self.pool:  # nothing left fits uncut
                    doc, start, length = self.take(min(self.pool))
                    part = min(gap, length)
                    window.append((doc, start, part))
                    if length > part:
                        self.add(doc, start + part, length - part)
                    gap -= part
                if gap:
                    for p in window:
                        self.add(*p)
                    return
                yield window
                if any(len(self.pool.get(k, ())) < n for k, n in chosen.items()):
                    break

    def rest(self) -> Iterator[list]:
        """What is left, as sequences whose lengths are powers of two."""
        pieces = [p for k in sorted(self.pool, reverse=True) for p in self.pool[k]]
        self.pool, self.size, self.tokens = {}, 0, 0
        total = sum(p[2] for p in pieces)
        pieces.reverse()
        for bit in reversed(range(total.bit_length())):
            room, window = (1 << bit) * (total >> bit & 1), []
            while room:
                doc, start, length = pieces.pop()
                if length > room:
                    pieces.append((doc, start + room, length - room))
                    length = room
                window.append((doc, start, length))
                room -= length
            if window:
                yield window


def _pack(batches, encoder: Ids, capacity: int, end_id: int, partition: int, high: int, low: int):
    import numpy as np
    import pyarrow as pa

    fields = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    schema = pa.schema([(f, pa.int64()) for f in fields])
    numbers, packer, rows = count(partition << 40), Packer(capacity), []

    def put(window):
        seq, at = next(numbers), 0
        for (doc_id, ids, base, total), start, length in window:
            part = ids[start - base:start - base + length]
            rows.append((doc_id, start, length, zlib.crc32(part.tobytes()), total, seq, at))
            at += length

    def flush():
        out = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * 7, schema=schema)
        rows.clear()
        return out

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            ids = np.append(encoder(text.as_py() or ""), np.array([end_id], "<u4"))
            full = len(ids) // capacity * capacity
            for s in range(0, full, capacity):
                put([((doc_id, ids, 0, len(ids)), s, capacity)])
            if full < len(ids):
                packer.add((doc_id, ids[full:].copy(), full, len(ids)), full, len(ids) - full)
            if packer.size >= high:
                for w in packer.windows(low):
                    put(w)
            if len(rows) >= 20_000:
                yield flush()
    for w in packer.windows(0):
        put(w)
    for w in packer.rest():
        put(w)
    if rows:
        yield flush()


def pack(docs: DataFrame, vocab_path: str, ranks_path: str | None = None, pattern: str | None = None, capacity: int = CAPACITY,
         end_id: int = END_ID, high: int = POOL_HIGH, low: int = POOL_LOW) -> DataFrame:
    """One row per piece of a document: where it starts, its length and checksum, and its place in a sequence."""
    def run(batches):
        from pyspark import TaskContext

        yield from _pack(batches, Ids(vocab_path, ranks_path, pattern), capacity, end_id, TaskContext.get().partitionId(), high, low)

    return docs.select(docs["doc_id"].cast("bigint"), docs["text"].cast("string")).mapInArrow(run, SCHEMA)


def pack_public(docs: DataFrame) -> DataFrame:
    """:func:`pack` with the public byte-level vocabulary."""
    import public_tokenizers as P

    return pack(docs, P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
