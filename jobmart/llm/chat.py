"""Chat formatting by incremental black-box rendering.

A template is any function from a list of (role, text) turns to a string. Nothing is assumed about it:
the turns of a conversation are rendered as growing prefixes, consecutive outputs are compared, and what
the longer one adds is the span of its last turn. Where the longer output does not start with the
shorter one, the template rewrites history: the turn is marked, and its span starts at the first change.

Conversations are streamed, never collected: rows are hashed by conversation, sorted by turn inside the
partition. Every prefix is the whole conversation up to its turn, so a task holds the turns of one conversation
and renders them once per turn. A template marked as ``additive`` renders turns one after the other, its output
for a + b being its output for a followed by that for b; what precedes a turn then cannot matter, and
after ``WINDOW`` turns the prefix restarts ``CONTEXT`` turns back: linear work and one window of memory in a
conversation of any length, with the same results. Each restart checks the mark on the window's output.

Defined results: null texts and roles are empty, rows order by turn, then role, then text (nulls first), so
repeated turns are all kept; a null conv_id is a conversation of its own; an empty table gives none.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW, CONTEXT = 32, 8
TARGET_ROLE = "assistant"


def escape(text: str) -> str:
    """Control strings, and the escape itself, get a backslash in front."""
    return text.replace("\\", "\\\\").replace("###", "\\###").replace("</turn>", "\\</turn>")


def escape_role(role: str) -> str:
    return re.sub(r"([\\:#<\n])", r"\\\1", role)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text


def additive(template: Callable) -> Callable:
    """Marks a template as concatenating its turns: template(a + b) == template(a) + template(b) for all a and b."""
    template.additive = True
    return template


@additive
def marked_turns(turns: list[tuple[str, str]]) -> str:
    """The default template: every turn between a role line and an end mark."""
    return "".join(f"### {escape_role(role)}:\n{escape(text)}\n</turn>\n" for role, text in turns)


_HEAD = re.compile(r"### ((?:\\.|[^\\:])*):\n", re.S)
_TAIL = "\n</turn>\n"


def read_turn(span: str) -> tuple[str, str, int, int] | None:
    """Role, text, and where the escaped text starts and ends in one rendered turn; None if it is not one."""
    m = _HEAD.match(span)
    if not m or not span.endswith(_TAIL) or len(span) < m.end() + len(_TAIL):
        return None
    a, b = m.end(), len(span) - len(_TAIL)
    return unescape(m[1]), unescape(span[a:b]), a, b


def _same(a: str, b: str) -> int:
    """Length of the common prefix."""
    if b.startswith(a):
        return len(a)
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[low:mid] == b[low:mid] else (low, mid - 1)
    return low


class Prefixes:
    """Renders growing prefixes of one conversation and yields what each turn adds."""

    def __init__(self, template: Callable, window: int = WINDOW, context: int = CONTEXT):
        self.template, self.window, self.context = template, window, context
        self.additive = getattr(template, "additive", False)
        self.turns, self.last = [], template([])

    def add(self, role: str, text: str) -> tuple[int, str]:
        """(how many characters of the previous output were taken back, what is new after the rest)."""
        if self.additive and len(self.turns) >= self.window:
            old, self.turns = self.turns[:-self.context], self.turns[-self.context:]
            tail = self.template(self.turns)
            if self.template(old) + tail != self.last:
                raise ValueError("the template is marked as additive, but its output depends on other turns")
            self.last = tail
        self.turns.append((role, text))
        now = self.template(self.turns)
        same = _same(self.last, now)
        back, self.last = len(self.last) - same, now
        return back, now[same:]


def _ordered(conversations: DataFrame) -> DataFrame:
    c = conversations.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), F.col("role").cast("string"), F.col("text").cast("string"))
    return c.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def _conversations(batches):
    """(first row of its conversation, conv_id, turn, role, text) in order."""
    last, begun = None, False
    for b in batches:
        for conv, turn, role, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3)):
            yield not begun or conv != last, conv, turn, role.as_py() or "", text.as_py() or ""
            last, begun = conv, True


def rendered(conversations: DataFrame, template: Callable = marked_turns) -> DataFrame:
    """One row per turn: its output, where it starts in the conversation's output, and whether history changed."""
    def run(batches):
        import pyarrow as pa

        names, rows, state, at, i = ["conv_id", "turn", "position", "start", "rewritten", "output"], [], None, 0, 0
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
        flush = lambda: pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names)
        size = 0
        for first, conv, turn, role, text in _conversations(batches):
            if first:
                state, i = Prefixes(template), 0
                at = len(state.last)
            back, new = state.add(role, text)
            at -= back
            rows.append((conv, turn, i, at, back, new))
            at, i, size = at + len(new), i + 1, size + len(new)
            if size > 4_000_000:
                yield flush()
                rows.clear()
                size = 0
        if rows:
            yield flush()

    return _ordered(conversations).mapInArrow(run, "conv_id bigint, turn bigint, position bigint, start bigint, rewritten bigint, output string")


def digests(conversations: DataFrame, template: Callable = marked_turns, reader: Callable = read_turn) -> DataFrame:
    """One row per conversation, read back from the rendered output of each turn."""
    def run(batches):
        import pyarrow as pa

        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_rewrites"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        done, state = [], None

        def close():
            done.append((state["conv"], state["n"], state["turns"].hexdigest(), state["loss_chars"], state["loss"].hexdigest(), state["chars"], state["rewrites"]))

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array([r[k] for r in done], t) for k, t in enumerate(types)], names)
            done.clear()
            return out

        for first, conv, _, role, text in _conversations(batches):
            if first:
                if state:
                    close()
                if len(done) >= 10_000:
                    yield flush()
                state = {"conv": conv, "n": 0, "turns": hashlib.sha256(), "loss": hashlib.sha256(), "loss_chars": 0, "rewrites": 0, "prefixes": Prefixes(template)}
                state["chars"] = len(state["prefixes"].last)
            back, new = state["prefixes"].add(role, text)
            state["chars"] += len(new) - back
            state["rewrites"] += back > 0
            got = reader(new)
            if got is None:
                raise ValueError(f"conversation {conv}: the rendered turn cannot be read back")
            state["n"] += 1
            state["turns"].update(f"{got[0]}\n{got[1]}\n".encode("utf-8", "surrogatepass"))
            if got[0] == TARGET_ROLE:
                state["loss"].update(got[1].encode("utf-8", "surrogatepass"))
                state["loss_chars"] += len(got[1])
        if state:
            close()
        if done:
            yield flush()

    return _ordered(conversations).mapInArrow(run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, n_rewrites bigint")


def with_probe(conversations: DataFrame) -> DataFrame:
    """The table plus conversation -7, whose texts hold the template's own control strings."""
    probe = conversations.sparkSession.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise(TARGET_ROLE).alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"))
    return conversations.select("conv_id", "turn", "role", "text").unionByName(probe)
