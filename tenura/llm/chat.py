"""Chat formatting: a state machine over roles and a declarative template with loss flags."""

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Template:
    """What stands around a turn, which roles may follow which, and whose texts count for the loss.

    `escape` marks control strings inside texts: every one of `start`, `end` and `escape` itself gets the
    escape character in front, so the marks of the template are the only bare ones and texts come back whole.
    """

    start: str = "<|im_start|>"
    end: str = "<|im_end|>"
    after_role: str = "\n"
    after_turn: str = "\n"
    escape: str = "\\"
    loss_roles: frozenset = frozenset({"assistant"})
    #: state -> role -> next state
    moves: dict = field(default_factory=lambda: {
        "begin": {"system": "told", "user": "asked"},
        "told": {"user": "asked"},
        "asked": {"assistant": "answered"},
        "answered": {"user": "asked"},
    }, hash=False)
    accepting: frozenset = frozenset({"asked", "answered"})

    def guard(self, text: str) -> str:
        marks = "|".join(re.escape(m) for m in (self.start, self.end, self.escape))
        return re.sub(marks, lambda m: self.escape + m[0], text)

    def bare(self, text: str) -> str:
        marks = "|".join(re.escape(m) for m in (self.start, self.end, self.escape))
        return re.sub(re.escape(self.escape) + f"({marks})", lambda m: m[1], text)

    def role(self, role: str) -> str:
        """Roles go on one line."""
        return self.guard(role).replace("\n", self.escape + "n")

    def bare_role(self, role: str) -> str:
        def one(m):
            return "\n" if m[1] == "n" else m[1]
        marks = "|".join(re.escape(m) for m in (self.start, self.end, self.escape))
        return re.sub(re.escape(self.escape) + f"({marks}|n)", one, role)

    def step(self, state: str, role: str) -> str:
        """Next state; `broken` once a role comes out of turn."""
        return self.moves.get(state, {}).get(role, "broken")

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """Text segments of one turn with their loss flags."""
        return [(self.start + self.role(role) + self.after_role, False),
                (self.guard(text), role in self.loss_roles), (self.end + self.after_turn, False)]


SEGMENTS = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("part", T.LongType()), T.StructField("state", T.StringType()),
    T.StructField("segments", T.ArrayType(T.StructType([
        T.StructField("text", T.StringType()), T.StructField("loss", T.BooleanType())]))),
])
_segments = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("state", pa.string()),
                       ("segments", pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())])))])
_none = object()


def _format(template: Template, part_chars: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted turns to parts of conversations, at most `part_chars` characters and one turn each."""
    conv, part, state, held, size, rows, total = _none, 0, "begin", [], 0, [], 0

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _segments)], schema=_segments)

    for batch in batches:
        for conv_id, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if conv is not _none and conv_id != conv or size > part_chars:
                rows.append((conv, part, state, [{"text": t, "loss": f} for t, f in held]))
                total += size
                part, held, size = part + 1, [], 0
                if total > 4 << 20:
                    yield out()
                    rows, total = [], 0
            if conv is _none or conv_id != conv:
                conv, part, state = conv_id, 0, "begin"
            state = template.step(state, role)
            turn = template.segments(role, text)
            held += turn
            size += sum(len(t) for t, _ in turn)
    if conv is not _none:
        rows.append((conv, part, state, [{"text": t, "loss": f} for t, f in held]))
    if rows:
        yield out()


def format_conversations(turns: DataFrame, template: Template = Template(), part_chars: int = 1 << 20) -> DataFrame:
    """Formatted conversations: rows (conv_id, part, state, segments array of (text, loss)).

    Turns are taken in order of turn (null first), ties by role and text; rows repeated in full stay
    repeated. Null text and null role count as empty, and an empty or unknown role is out of turn. Rows
    with a null conv_id are one conversation. An empty table gives no row. `state` is the state after the part; `broken` if a role came
    out of turn, in which case the turns are still formatted. Other columns are not read.

    A conversation is dealt to one task and streamed in order, as its digest needs. It comes out in parts
    of bounded size, numbered from 0 and consecutive in its partition, so a very long one never has to fit
    in memory.
    """
    rows = turns.select(
        turns["conv_id"].cast("long").alias("conv_id"), turns["turn"].cast("long").alias("turn"),
        F.coalesce(turns["role"].cast("string"), F.lit("")).alias("role"),
        F.coalesce(turns["text"].cast("string"), F.lit("")).alias("text"))
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.select("conv_id", "role", "text").mapInArrow(lambda b: _format(template, part_chars, b), SEGMENTS)


DIGESTS = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()),
    T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()),
    T.StructField("formatted_chars", T.LongType()), T.StructField("valid", T.BooleanType()),
])


def _read_back(template: Template, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # A bare mark: one that no odd run of escape characters precedes.
    esc = re.escape(template.escape)
    mark = re.compile(f"(?:{esc}(?:{esc}|{re.escape(template.start)}|{re.escape(template.end)}|n))"
                      f"|({re.escape(template.start)}|{re.escape(template.end)})")
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("valid", pa.bool_())])

    def turns_of(formatted: str) -> Iterator[tuple[str, str]]:
        begin = None
        for m in mark.finditer(formatted):
            if m[1] == template.start:
                begin = m.end()
            elif m[1] == template.end:
                role, text = formatted[begin:m.start()].split(template.after_role, 1)
                yield template.bare_role(role), template.bare(text)

    conv = _none
    n = chars = loss = expected = 0
    turns_hash = loss_hash = state = None
    rows = []
    for batch in batches:
        for conv_id, part, now, segments in zip(*(c.to_pylist() for c in batch.columns)):
            if conv is _none or conv_id != conv:
                if conv is not _none:
                    rows.append((conv, n, turns_hash.hexdigest(), loss, loss_hash.hexdigest(), chars, state in template.accepting))
                conv, n, chars, loss, expected = conv_id, 0, 0, 0, 0
                turns_hash, loss_hash = hashlib.sha256(), hashlib.sha256()
            if part != expected:
                raise ValueError(f"part {part} of conversation {conv_id} stands where part {expected} belongs")
            state, expected = now, expected + 1
            formatted = "".join(s["text"] for s in segments)
            chars += len(formatted)
            for role, text in turns_of(formatted):
                n += 1
                turns_hash.update(f"{role}\n{text}\n".encode())
            at = 0
            for s in segments:
                if s["loss"]:  # the mask is a span of the formatted text
                    masked = template.bare(formatted[at:at + len(s["text"])])
                    loss += len(masked)
                    loss_hash.update(masked.encode())
                at += len(s["text"])
    if conv is not _none:
        rows.append((conv, n, turns_hash.hexdigest(), loss, loss_hash.hexdigest(), chars, state in template.accepting))
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def read_back(formatted: DataFrame, template: Template = Template(), in_order: bool = False) -> DataFrame:
    """Per conversation what its formatted text holds: n_turns, turns_sha256 (role, \\n, text, \\n of each
    turn), loss_chars and loss_sha256 of the unescaped text under the loss mask, formatted_chars, valid
    (roles in turn). Parts may come in any order and from any table; a missing or repeated one is an error.
    `in_order` spares the shuffle where the rows come straight from `format_conversations`."""
    parts = formatted.select("conv_id", "part", "state", "segments")
    if not in_order:
        parts = parts.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return parts.mapInArrow(lambda b: _read_back(template, b), DIGESTS)
