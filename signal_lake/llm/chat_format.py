"""Chat formatting by a finite-state machine over roles and a declarative template.

Method: a template names, for each role, the segments of a turn: literals, the role and the text, each with a loss flag; and, for each
state, the roles that may follow and the state they lead to. Rows go to their conversation's task in the order of turns; the machine runs
over them as a stream, one turn at a time, and each turn becomes segments. No conversation is held in memory, however long.

Control strings are the template's literals without blanks around them. In texts each of them, and the escape character, is replaced
by the escape character and a digit, so no literal can appear in a text, and the replacement is undone on reading. ``read_back`` parses
the concatenated segments with nothing but the template.

Results for odd input: a NULL text or role is an empty one. A role the template does not name takes the segments of ``*``,
where the role itself is a segment. A turn the machine does not allow is formatted all the same, flagged, and the
machine goes on from that role. Turns with an equal number are ordered by role and text; repeated rows are turns of their own. A NULL turn
comes first; rows with a NULL conv_id are one conversation. An empty table gives an empty result. Columns other than those named are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from signal_lake.llm.common import prepare

ESCAPE = "\\"


@dataclass(frozen=True)
class Segment:
    """A literal, or with ``field`` the role or text of the turn; ``loss`` says whether a model learns it."""

    literal: str = ""
    field: str = ""
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Segments by role and the machine: state -> {role: next state}; ``final`` states may end a conversation."""

    roles: dict[str, tuple[Segment, ...]]
    machine: dict[str, dict[str, str]]
    start: str
    final: frozenset[str]

    def __post_init__(self) -> None:
        for role, segments in self.roles.items():
            for a, b in zip(segments, [*segments[1:], Segment()], strict=True):
                if a.field and not b.literal:
                    raise ValueError(f"{role}: a {a.field} needs a literal after it, to end it")
            if not segments[0].literal:
                raise ValueError(f"{role}: a turn starts with a literal")
        for literal in self.controls:
            if not literal or ESCAPE in literal or any(literal[:k] == literal[-k:] for k in range(1, len(literal))):
                raise ValueError(f"{literal!r} can't be found without doubt after a text")
            if literal[0].isdigit():
                raise ValueError(f"{literal!r} starts like an escape")
        if len(self.controls) > 9:
            raise ValueError("an escape is one digit")

    @cached_property
    def controls(self) -> list[str]:
        literals = {s.literal.strip() for segments in self.roles.values() for s in segments if s.literal}
        return sorted(literals, key=lambda x: (-len(x), x))

    @cached_property
    def _codes(self) -> tuple[re.Pattern, dict[str, str], dict[str, str]]:
        strings = [ESCAPE, *self.controls]
        there = {s: f"{ESCAPE}{i}" for i, s in enumerate(strings)}
        return re.compile("|".join(map(re.escape, strings))), there, {v: k for k, v in there.items()}

    def escape(self, text: str) -> str:
        pattern, there, _ = self._codes
        return pattern.sub(lambda m: there[m[0]], text)

    def unescape(self, text: str) -> str:
        back = self._codes[2]
        return re.sub(re.escape(ESCAPE) + r"\d", lambda m: back[m[0]], text) if ESCAPE in text else text

    def segments(self, role: str, text: str) -> Iterator[tuple[str, bool]]:
        """Texts and loss flags of one turn."""
        for s in self.roles.get(role, self.roles["*"]):
            yield (s.literal or self.escape(role if s.field == "role" else text)), s.loss

    def step(self, state: str, role: str) -> tuple[str, bool]:
        """Next state, and whether the machine allows the role here."""
        following = self.machine.get(state, {})
        if role in following:
            return following[role], True
        return next((to[role] for to in self.machine.values() if role in to), state), False

    def parse(self, text: str) -> Iterator[tuple[str, str, list[tuple[str, bool]]]]:
        """(role, text, segments) of each turn of a formatted text; the inverse of formatting."""
        starts = sorted(self.roles, key=lambda r: -len(self.roles[r][0].literal))
        at = 0
        while at < len(text):
            role = next((r for r in starts if text.startswith(self.roles[r][0].literal, at)), None)
            if role is None:
                raise ValueError(f"no turn starts at {at}")
            segments, found, fields = self.roles[role], [], {"role": role, "text": ""}
            for k, s in enumerate(segments):
                if s.literal:
                    if not text.startswith(s.literal, at):
                        raise ValueError(f"{s.literal!r} is missing at {at}")
                    end = at + len(s.literal)
                else:
                    end = text.find(segments[k + 1].literal, at)
                    if end < 0:
                        raise ValueError(f"the {s.field} at {at} has no end")
                    fields[s.field] = self.unescape(text[at:end])
                found.append((text[at:end], s.loss))
                at = end
            yield fields["role"], fields["text"], found


def _turn(opening: str, role: bool = False, loss: bool = False) -> tuple[Segment, ...]:
    named = (Segment(field="role"), Segment("\n### Text: ")) if role else ()
    return (Segment(opening), *named, Segment(field="text", loss=loss), Segment("</turn>\n"))


#: System turn first, then user and assistant in turn; a conversation ends with an assistant.
DEFAULT = Template(
    roles={
        "system": _turn("### System: "),
        "user": _turn("### User: "),
        "assistant": _turn("### Assistant: ", loss=True),
        "*": _turn("### Role: ", role=True),
    },
    machine={"start": {"system": "ready", "user": "asked"}, "ready": {"user": "asked"}, "asked": {"assistant": "answered"}, "answered": {"user": "asked"}},
    start="start",
    final=frozenset({"answered"}),
)

_SEGMENT = "number bigint, segment bigint, text string, loss boolean, state string, allowed boolean"


def format_turns(turns: DataFrame, template: Template = DEFAULT, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A row per segment, in order within its conversation's partition: (conv, number, segment, text, loss, state, allowed).

    ``number`` counts the turns of the conversation, ``state`` is the machine's after the turn.
    """
    prepare(turns.sparkSession)
    kind = turns.schema[conversation].dataType.simpleString()
    rows = turns.select(F.col(conversation).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ordered = rows.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: object = run  # no conversation is this
        state, number = template.start, 0
        for batch in batches:
            out: list[tuple] = []
            owner = []
            for i, (conv, role_, text_) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                if conv != current:
                    current, state, number = conv, template.start, 0
                state, allowed = template.step(state, role_)
                for k, (piece, loss) in enumerate(template.segments(role_, text_)):
                    owner.append(i)
                    out.append((number, k, piece, loss, state, allowed))
                number += 1
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.string(), pa.bool_()]
            columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)] if out else [pa.array([], k) for k in kinds]
            yield pa.record_batch([batch.column(0).take(pa.array(owner, pa.int64())), *columns], ["conv", *(f.split()[0] for f in _SEGMENT.split(", "))])

    return ordered.mapInArrow(run, f"conv {kind}, {_SEGMENT}")


def read_back(segments: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """Digests of what the formatted texts say, a row per conversation; ``segments`` as ``format_turns`` leaves them.

    The text of a turn, its segments joined, is parsed; loss flags are those of the segments that came along, held
    against those the template gives. valid: every turn was allowed and the last state is final.
    """
    kind = segments.schema["conv"].dataType.simpleString()
    names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid"]

    class Reader:
        def __init__(self, conv: object):
            self.conv, self.turns, self.loss_chars, self.chars, self.valid, self.state = conv, 0, 0, 0, True, template.start
            self.said, self.learned = hashlib.sha256(), hashlib.sha256()

        def take(self, parts: list[tuple[str, bool]], state: str, allowed: bool) -> None:
            whole = "".join(t for t, _ in parts)
            for role, text, found in template.parse(whole):
                if found != parts:
                    raise ValueError(f"segments of conversation {self.conv} differ from the template's")
                self.turns += 1
                self.said.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                for piece, loss in found:
                    if loss:
                        plain = template.unescape(piece)
                        self.loss_chars += len(plain)
                        self.learned.update(plain.encode("utf-8", "surrogatepass"))
            self.chars += len(whole)
            self.valid, self.state = self.valid and allowed, state

        def row(self) -> tuple:
            return self.conv, self.turns, self.said.hexdigest(), self.loss_chars, self.learned.hexdigest(), self.chars, self.valid and self.state in template.final

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader: Reader | None = None
        parts: list[tuple[str, bool]] = []
        open_turn: tuple | None = None  # conversation, number, state, allowed
        for batch in batches:
            done: list[tuple] = []
            for conv, number, segment, text, loss, state, allowed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if segment == 0:
                    if open_turn is not None:
                        reader.take(parts, *open_turn[2:])
                    if reader is None or number == 0:
                        if reader is not None:
                            done.append(reader.row())
                        reader = Reader(conv)
                    parts, open_turn = [], (conv, number, state, allowed)
                parts.append((text, loss))
            if done:
                yield packed(done, batch.schema.field("conv").type)
            last = batch.schema.field("conv").type
        if reader is not None:
            reader.take(parts, *open_turn[2:])
            yield packed([reader.row()], last)

    def packed(rows: list[tuple], key: pa.DataType) -> pa.RecordBatch:
        kinds = [key, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    schema = f"conv {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, valid boolean"
    return segments.mapInArrow(run, schema)
