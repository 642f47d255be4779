"""Chat formatting: a state machine over roles and a declarative template.

The rows of a conversation stream through in turn order (Spark partitions by conversation
and sorts; nothing holds a whole conversation).  The machine follows the roles and notes
where their order breaks; the template gives each turn's text marks before and behind and
says whether the loss counts on the text.  Each turn becomes segments with a loss flag:
marks without loss, an assistant's text with it.

Control strings inside texts are escaped so that no text can forge a mark: a backslash is
doubled, and a control string gets one after its first character.  Dropping one backslash
of each pair or before any character undoes it.

Defined results: null texts and roles are empty; rows of equal turn are ordered by role and
text, null turns come first; rows without ``conv_id`` form one conversation; roles that
the template doesn't list get a mark that names them; conversations whose roles are out of
order are formatted like others, and ``valid`` is false; extra columns aren't carried.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, BROKEN = "start", "broken"


@dataclass(frozen=True)
class Turn:
    before: str
    behind: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Marks by role, the marks of other roles, and the machine: the states that a role
    leads to from a state, and those a conversation may end in."""

    turns: dict[str, Turn]
    other: tuple[str, str, str] = ("[ROLE] ", " [/ROLE] ", " [/TURN]")
    moves: dict[tuple[str, str], str] = field(default_factory=dict)
    final: frozenset = frozenset()

    def controls(self) -> list[str]:
        marks = [m for t in self.turns.values() for m in (t.before, t.behind)] + list(self.other)
        return sorted({w for m in marks for w in m.split()}, key=lambda w: (-len(w), w))


INSTRUCT = Template(
    turns={"system": Turn("<<SYS>> ", " <</SYS>> "), "user": Turn("<s> [INST] ", " [/INST]"),
           "assistant": Turn(" [ANS] ", " </s>", loss=True)},
    moves={(START, "system"): "system", (START, "user"): "user", ("system", "user"): "user",
           ("user", "assistant"): "assistant", ("assistant", "user"): "user"},
    final=frozenset({"assistant"}),
)

FORMATTED = "conv_id long, seq long, valid boolean, segments array<struct<text:string,loss:boolean>>"
RESULT = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
          "formatted_chars long, valid boolean")


def escaper(template: Template):
    find = re.compile("|".join([re.escape("\\")] + [re.escape(c) for c in template.controls()]))
    return lambda text: find.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def format_turn(template: Template, escape, role: str, text: str) -> list[tuple[str, bool]]:
    """Segments (text, loss) of a turn."""
    turn = template.turns.get(role)
    if turn is None:
        a, b, c = template.other
        turn = Turn(a + escape(role) + b, c)
    return [(turn.before, False), (escape(text), turn.loss), (turn.behind, False)]


def parse_turn(template: Template, segments: list[tuple[str, bool]]) -> tuple[str, str, str]:
    """Role, text and the text under the loss, from the segments."""
    whole = "".join(s for s, _ in segments)
    loss = unescape("".join(s for s, on in segments if on))
    for role, turn in template.turns.items():
        if whole.startswith(turn.before) and whole.endswith(turn.behind) and len(whole) >= len(turn.before) + len(turn.behind):
            return role, unescape(whole[len(turn.before): len(whole) - len(turn.behind)]), loss
    a, b, c = template.other
    end = whole.index(b, len(a))
    return unescape(whole[len(a): end]), unescape(whole[end + len(b): len(whole) - len(c)]), loss


def in_turn_order(df: DataFrame, *order: str) -> DataFrame:
    return df.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def format_conversations(df: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """One row a turn: ``conv_id``, ``seq`` (from 0), ``valid`` (the order of roles holds up
    to here) and ``segments``."""
    rows = df.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    kind = pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        escape, moves = escaper(template), template.moves
        current, state, seq = object(), START, 0
        for batch in batches:
            ids, seqs, valid, segments = [], [], [], []
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if conv != current:
                    current, state, seq = conv, START, 0
                state = moves.get((state, role), BROKEN)
                ids.append(conv)
                seqs.append(seq)
                valid.append(state != BROKEN)
                segments.append([{"text": s, "loss": on} for s, on in format_turn(template, escape, role, text)])
                seq += 1
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(seqs, pa.int64()), pa.array(valid),
                                              pa.array(segments, kind)], names=["conv_id", "seq", "valid", "segments"])

    return in_turn_order(rows, "turn", "role", "text").mapInArrow(run, FORMATTED)


def read_conversations(formatted: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """One row a conversation, read back from formatted turns."""
    names = [x.split()[0] for x in RESULT.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = object()
        current, n, chars, loss_chars, ok, last = none, 0, 0, 0, True, START
        turns, loss = hashlib.sha256(), hashlib.sha256()
        done: list[tuple] = []

        def close() -> None:
            if current is not none:
                done.append((current, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, ok and last in template.final))

        for batch in batches:
            for conv, valid, segments in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "valid", "segments"))):
                if conv != current:
                    close()
                    current, n, chars, loss_chars, ok = conv, 0, 0, 0, True
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                pairs = [(s["text"], s["loss"]) for s in segments]
                role, text, under = parse_turn(template, pairs)
                turns.update(f"{role}\n{text}\n".encode())
                loss.update(under.encode())
                n, loss_chars, ok, last = n + 1, loss_chars + len(under), ok and valid, role
                chars += sum(len(s) for s, _ in pairs)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)
                done.clear()
        close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)

    return in_turn_order(formatted, "seq").mapInArrow(run, RESULT)
