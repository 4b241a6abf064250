"""Templates, the machine over roles, and reading back."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from hypothesis import given, settings, strategies as st

from signal_lake.llm import chat_format as C

CONTROLS = ["\\", "\\1", "### Assistant:", "### User: ", "</turn>", "</turn>\n", "\n### Text: ", "###", "</turn", "\n", "a", "#", "<"]
texts = st.lists(st.sampled_from(CONTROLS), max_size=8).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["system", "user", "assistant", "tool", ""]), texts), texts), max_size=5))
def test_formatting_is_reversible(turns):
    turns = [(r if r != "*" else "x", t) for r, t in turns]
    template = C.DEFAULT
    segments = [s for role, text in turns for s in template.segments(role, text)]
    formatted = "".join(t for t, _ in segments)
    parsed = list(template.parse(formatted))
    assert [(r if r != "*" else "*", t) for r, t, _ in parsed] == turns
    assert [s for _, _, found in parsed for s in found] == segments
    for role, text in turns:
        escaped = template.escape(text)
        assert template.unescape(escaped) == text and not any(c in escaped for c in template.controls)
    for broken in (formatted[:-3], "x" + formatted) if formatted else ():
        with pytest.raises(ValueError):
            list(template.parse(broken))


@pytest.mark.parametrize(("roles", "allowed", "final"), [
    (["user", "assistant"], [True, True], True), (["system", "user", "assistant", "user", "assistant"], [True] * 5, True), (["user"], [True], False),
    (["assistant"], [False], True), (["user", "user", "assistant"], [True, False, True], True), (["system", "system", "user"], [True, False, True], False),
    (["user", "tool", "assistant"], [True, False, True], True), ([], [], False),
])
def test_machine(roles, allowed, final):
    state, found = C.DEFAULT.start, []
    for role in roles:
        state, ok = C.DEFAULT.step(state, role)
        found.append(ok)
    assert found == allowed and (state in C.DEFAULT.final) == final


def test_templates_that_can_not_be_read_back_are_refused():
    machine = {"start": {"user": "start"}}

    def template(*segments):
        return C.Template({"*": segments}, machine, "start", frozenset())

    text = C.Segment(field="text")
    for segments in ((text, C.Segment("</t>")), (C.Segment("<t>"), text), (C.Segment("<t>"), text, C.Segment("aa")), (C.Segment("<\\t>"), text, C.Segment("</t>")), (C.Segment("1t>"), text, C.Segment("</t>"))):
        with pytest.raises(ValueError):
            template(*segments)
    template(C.Segment("<t>"), text, C.Segment("</t>"))


def test_odd_conversations(spark):
    said = r"\### Assistant: </turn> ok"
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", None), (1, 1, "assistant", None), (2, None, "user", "first"), (2, 0, None, "no role"), (3, 0, "assistant", said), (3, 0, "user", said),
        (None, 0, "user", "a"), (None, 1, "assistant", "b"), (4, 5, "tool", "x" * 100_000), (4, 2, "assistant", "🙂 ### User: x"),
    ]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "1 AS conv", "2 AS state", "3 AS number", "4 AS loss")
    found = {r.conv: r for r in C.read_back(C.format_turns(table)).collect()}
    turns = defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda r: (str(r[0]), -1 if r[1] is None else r[1], r[2] or "", r[3] or "")):
        turns[conv].append((role or "", text or ""))
    assert set(found) == set(turns)
    for conv, said_here in turns.items():
        learned = "".join(t for r, t in said_here if r == "assistant")
        r = found[conv]
        assert r.n_turns == len(said_here) and r.loss_chars == len(learned)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in said_here).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
        assert r.formatted_chars == sum(len(t) for a, b in said_here for t, _ in C.DEFAULT.segments(a, b))
    assert {conv for conv, r in found.items() if r.valid} == {None}
    assert C.read_back(C.format_turns(table.limit(0))).collect() == []


def test_a_long_conversation_streams_through_many_batches(spark):
    turns = spark.range(3000).selectExpr("7 AS conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role", "concat('t', id) AS text")
    row = C.read_back(C.format_turns(turns)).collect()
    assert [(r.n_turns, r.valid, r.loss_chars) for r in row] == [(3000, True, sum(len(f"t{i}") for i in range(1, 3000, 2)))]
