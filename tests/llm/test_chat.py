"""Chat formatting: exact round trip, loss mask, history rewrites, long conversations."""

import hashlib
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from jobmart.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def expected(turns):
    texts = [t for r, t in turns if r == "assistant"]
    return (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), sum(map(len, texts)),
            hashlib.sha256("".join(texts).encode()).hexdigest(), len(chat.marked_turns(turns)))


def got(row):
    return (row.n_turns, row.turns_sha256, row.loss_chars, row.loss_sha256, row.formatted_chars)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "", "a:b\n\\#<"]), st.lists(st.sampled_from(["\\", "#", "###", "</turn>", "\n", ":", "### assistant:\n", "a"]), max_size=8).map("".join)), max_size=6))
def test_round_trip(turns):
    p, back = chat.Prefixes(chat.marked_turns), []
    for role, text in turns:
        taken, new = p.add(role, text)
        assert taken == 0
        back.append(chat.read_turn(new)[:2])
    assert back == turns


def test_digests(spark):
    probe = "\\### Assistant: </turn> ok"
    rows = [(1, 1, "assistant", "b </turn>"), (1, 0, "user", "a"), (2, 0, None, None), (2, None, "user", "first"), (3, 0, "user", "x"), (3, 0, "user", "x"), (None, 0, "assistant", "n")]
    out = {r.conv_id: r for r in chat.digests(chat.with_probe(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert got(out[1]) == expected([("user", "a"), ("assistant", "b </turn>")])
    assert got(out[2]) == expected([("user", "first"), ("", "")])
    assert got(out[3]) == expected([("user", "x")] * 2)
    assert got(out[None]) == expected([("assistant", "n")])
    assert got(out[-7]) == expected([("user", probe), ("assistant", probe)]) and len(out) == 5


def test_long_conversation_in_windows(spark):
    turns = [("assistant" if i % 2 else "user", f"t{i} \\###") for i in range(300)]
    rows = [(9, i, r, t) for i, (r, t) in enumerate(turns)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert got(chat.digests(df).collect()[0]) == expected(turns)
    parts = sorted(chat.rendered(df).collect(), key=lambda r: r.position)
    assert "".join(r.output for r in parts) == chat.marked_turns(turns)
    assert [r.start for r in parts] == [len(chat.marked_turns(turns[:i])) for i in range(300)]


def test_rewriting_template_is_detected(spark):
    def forgets(turns):  # drops all earlier texts of the assistant
        return "".join(f"<{r}>{'' if r == 'assistant' and i < len(turns) - 1 else t}" for i, (r, t) in enumerate(turns))

    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "long answer"), (1, 2, "user", "again")]
    out = sorted(chat.rendered(spark.createDataFrame(rows, SCHEMA), forgets).collect(), key=lambda r: r.position)
    assert [r.rewritten > 0 for r in out] == [False, False, True] and out[2].rewritten == len("long answer")


def templates():
    """Inside a function, so that they are sent to the tasks with their code."""
    def numbered(turns):  # the output of a turn depends on its position
        return "".join(f"{i} {r}: {t}\n" for i, (r, t) in enumerate(turns))

    def counted(turns):  # every turn rewrites the first line
        return f"{len(turns)} turns\n" + "".join(f"{r}: {t}\n" for r, t in turns)

    def shortened(turns):  # leaves the oldest turns out from turn 201 on
        return "".join(f"{r}: {t}\n" for r, t in turns[-200:])

    return {"numbered": (numbered, 0), "counted": (counted, 300), "shortened": (shortened, 100)}


@pytest.mark.parametrize("name", ["numbered", "counted", "shortened"])
def test_long_conversations_are_rendered_as_true_prefixes(spark, name):
    template, rewrites = templates()[name]
    turns = [("assistant" if i % 2 else "user", f"t{i}") for i in range(300)]
    parts = sorted(chat.rendered(spark.createDataFrame([(9, i, r, t) for i, (r, t) in enumerate(turns)], SCHEMA), template).collect(), key=lambda r: r.position)
    whole = template([])
    for i, r in enumerate(parts):
        now = template(turns[:i + 1])
        same = len(os.path.commonprefix([whole, now]))
        assert (r.start, r.rewritten, r.output) == (same, len(whole) - same, now[same:])
        whole = now
    assert sum(r.rewritten > 0 for r in parts) == rewrites


def test_a_wrong_additive_mark_is_refused():
    p = chat.Prefixes(chat.additive(templates()["numbered"][0]))
    with pytest.raises(ValueError, match="additive"):
        for i in range(40):
            p.add("user", f"t{i}")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text("\\#:<\na"), st.text("\\#</turn>\n"))), st.lists(st.tuples(st.text("\\#:<\na"), st.text("\\#</turn>\n"))))
def test_the_default_template_is_additive(a, b):
    assert chat.marked_turns(a + b) == chat.marked_turns(a) + chat.marked_turns(b)


@given(st.text("ab", max_size=12), st.text("ab", max_size=12))
def test_common_prefix(a, b):
    assert chat._same(a, b) == len(os.path.commonprefix([a, b]))


def test_empty_table(spark):
    assert chat.digests(spark.createDataFrame([], SCHEMA)).count() == 0
