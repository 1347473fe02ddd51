"""Chat formatting: a state machine over roles and a declarative template with loss flags."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from mergewell.llm.rows import SLICE


@dataclass(frozen=True)
class Template:
    """Marks around the turns of each role, roles that bear loss, and the order of turns.

    Every opening mark ends and every closing mark begins with a blank, and no control string
    (a mark without that blank) holds one: so text beside a mark never completes another mark.
    """

    turns: dict[str, tuple[str, str]] = field(default_factory=lambda: {
        "system": ("<<SYS>> ", " <</SYS>>"),
        "user": ("[INST] ", " [/INST]"),
        "assistant": ("<s> ", " </s>"),
    })
    other: tuple[str, str, str] = ("[ROLE] ", " [:] ", " [/ROLE]")  # any other role, by its name
    loss: frozenset[str] = frozenset({"assistant"})
    start: str = "start"
    follows: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "start": ("system", "user"),
        "system": ("user",),
        "user": ("assistant",),
        "assistant": ("user",),
    })
    final: frozenset[str] = frozenset({"user", "assistant"})

    def __post_init__(self):
        opening = [o for o, _ in self.turns.values()] + [self.other[0], self.other[1]]
        closing = [c for _, c in self.turns.values()] + [self.other[1], self.other[2]]
        if not all(o.endswith(" ") for o in opening) or not all(c.startswith(" ") for c in closing):
            raise ValueError("marks need a blank towards the text")
        if any(" " in c or "\\" in c or not c for c in self.controls()):
            raise ValueError("control strings hold no blank and no backslash")

    def controls(self) -> list[str]:
        marks = [m for pair in self.turns.values() for m in pair] + list(self.other)
        return sorted({m.strip(" ") for m in marks})


class Formatter:
    """Turns to segments and back."""

    def __init__(self, template: Template):
        self.template = template
        # A backslash, or the first letter of a control string wherever one begins.
        self.special = re.compile(
            r"\\|(?=" + "|".join(map(re.escape, template.controls())) + ").", re.DOTALL)
        self.escaped = re.compile(r"\\([0-9a-f]+);")

    def escape(self, text: str) -> str:
        return self.special.sub(lambda m: f"\\{ord(m[0]):x};", text)

    def unescape(self, text: str) -> str:
        return self.escaped.sub(lambda m: chr(int(m[1], 16)), text) if "\\" in text else text

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """(text, loss) pieces of one turn."""
        marks = self.template.turns.get(role)
        body = (self.escape(text), role in self.template.loss)
        if marks is None:
            before, between, after = self.template.other
            return [(before + self.escape(role) + between, False), body, (after, False)]
        return [(marks[0], False), body, (marks[1], False)]

    def step(self, state: str | None, role: str) -> str | None:
        """The state after a turn; None once the order is broken."""
        return role if state is not None and role in self.template.follows.get(state, ()) else None

    def parse(self, formatted: str) -> tuple[str, str]:
        """(role, text) of one formatted turn."""
        for role, (before, after) in self.template.turns.items():
            if formatted.startswith(before) and formatted.endswith(after):
                return role, self.unescape(formatted[len(before):-len(after)])
        before, between, after = self.template.other
        if not (formatted.startswith(before) and formatted.endswith(after)):
            raise ValueError("not a formatted turn")
        name, text = formatted[len(before):-len(after)].split(between, 1)
        return self.unescape(name), self.unescape(text)

    def closing(self) -> re.Pattern:
        """Where a turn ends."""
        marks = [after for _, after in self.template.turns.values()] + [self.template.other[2]]
        return re.compile("|".join(map(re.escape, sorted(marks, key=len, reverse=True))))


_SEGMENTS = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("place", T.LongType()),
    T.StructField("piece", T.IntegerType()), T.StructField("text", T.StringType()),
    T.StructField("loss", T.BooleanType()), T.StructField("in_order", T.BooleanType())])
_DIGESTS = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("n_turns", T.LongType()),
    T.StructField("turns_sha256", T.StringType()), T.StructField("loss_chars", T.LongType()),
    T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType()),
    T.StructField("valid", T.BooleanType())])


def _batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[f.dataType.simpleString()]) for c, f in zip(zip(*rows), schema)],
        names=schema.names)


def _values(batches):
    for whole in batches:
        for first in range(0, whole.num_rows, SLICE):
            batch = whole.slice(first, SLICE)
            yield from zip(*[c.to_pylist() for c in batch.columns])


def format_conversations(df: DataFrame, template: Template | None = None) -> DataFrame:
    """Segments (conv_id, place, piece, text, loss, in_order) of all conversations in df.

    df: conv_id, turn, role, text.  Turns stand in order of turn, then role and text; place
    counts them from 0.  in_order says whether the state machine accepts all turns so far.
    Conversations in a wrong order are formatted as well.  A missing text or role is empty; a
    missing turn comes first; a row without conv_id is a conversation of its own; repeated
    rows are repeated turns; other columns are left out; an empty table has no segments.

    Rows are sorted by conversation and streamed: a conversation of any length needs the
    memory of one batch, and all its segments lie in one partition in their order.
    """
    template = template or Template()
    rows = df.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    alone = F.when(F.col("conv_id").isNull(), F.xxhash64("turn", "role", "text"))
    ordered = rows.withColumn("alone", alone).repartition("conv_id", "alone").sortWithinPartitions(
        "conv_id", "alone", "turn", "role", "text").select("conv_id", "role", "text")

    def work(batches):
        formatter = Formatter(template)
        conversation, place, state, out = None, 0, template.start, []
        for conv_id, role, text in _values(batches):
            if conv_id is None or place == 0 or conv_id != conversation:
                conversation, place, state = conv_id, 0, template.start
            state = formatter.step(state, role)
            out += [(conv_id, place, piece, part, loss, state is not None)
                    for piece, (part, loss) in enumerate(formatter.segments(role, text))]
            place += 1
            if len(out) >= SLICE:
                yield _batch(out, _SEGMENTS)
                out = []
        if out:
            yield _batch(out, _SEGMENTS)

    return ordered.mapInArrow(work, _SEGMENTS)


class _Reading:
    """One conversation that is read back from its segments."""

    def __init__(self, conv_id):
        self.conv_id, self.turns, self.chars, self.loss = conv_id, 0, 0, 0
        self.all, self.under_loss = hashlib.sha256(), hashlib.sha256()
        self.pending, self.valid, self.role = "", True, None

    def add(self, formatter, closing, text, loss, in_order):
        self.chars += len(text)
        self.valid = in_order
        if loss:
            plain = formatter.unescape(text)
            self.loss += len(plain)
            self.under_loss.update(plain.encode("utf-8", "surrogatepass"))
        self.pending += text
        end = closing.search(self.pending)
        while end:
            self.role, words = formatter.parse(self.pending[:end.end()])
            self.all.update(f"{self.role}\n{words}\n".encode("utf-8", "surrogatepass"))
            self.turns += 1
            self.pending = self.pending[end.end():]
            end = closing.search(self.pending)

    def row(self, template):
        return (self.conv_id, self.turns, self.all.hexdigest(), self.loss,
                self.under_loss.hexdigest(), self.chars, self.valid and self.role in template.final)


def read_back(segments: DataFrame, template: Template | None = None) -> DataFrame:
    """One line per conversation from the output of format_conversations: conv_id, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars, valid.

    Only the formatted text and the loss flags are used: turns are parsed from the text.
    Segments have to come in the order in which they were made; any other is refused, as it
    would give wrong digests."""
    template = template or Template()

    def work(batches):
        formatter = Formatter(template)
        closing = formatter.closing()
        now, last, out = None, None, []
        for conv_id, place, piece, text, loss, in_order in _values(batches):
            if place == 0 and piece == 0:
                if now is not None:
                    out.append(now.row(template))
                now = _Reading(conv_id)
            elif now is None or conv_id != now.conv_id or (place, piece) not in (
                    (last[0], last[1] + 1), (last[0] + 1, 0)):
                raise ValueError("segments are not in the order in which they were made")
            last = (place, piece)
            now.add(formatter, closing, text, loss, in_order)
            if len(out) >= SLICE:
                yield _batch(out, _DIGESTS)
                out = []
        if now is not None:
            out.append(now.row(template))
            yield _batch(out, _DIGESTS)

    return segments.mapInArrow(work, _DIGESTS)
