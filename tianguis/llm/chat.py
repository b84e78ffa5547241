"""Chat formatting that survives a round trip.

A turn is written as ``### <role>:`` and a line break, its text, and ``</turn>`` and a line break. The rendered
turn is parsed again by a deterministic parser; if role and text do not come back, or if the bare text holds a
control string, the text is escaped and the header ends in ``:\\`` instead of ``:``. Only then is it accepted.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOSS_ROLE = "assistant"

# The control strings of the template.
OPEN, HEAD_END, ESCAPED_HEAD_END, CLOSE = "### ", ":\n", ":\\\n", "</turn>\n"
CONTROL = ("###", "</turn>")

_ESCAPE = re.compile(r"\\|###|</turn>")
_UNESCAPE = re.compile(r"\\(\\|###|</turn>)")
_ROLE_ESCAPE = re.compile(r"[\\:\n]")
_ROLE_UNESCAPE = re.compile(r"\\([\\cn])")
_ROLE_LETTERS = {"\\": "\\\\", ":": "\\c", "\n": "\\n"}
_ROLE_BACK = {"\\": "\\", "c": ":", "n": "\n"}


class NotReadable(ValueError):
    """Rendered text that the grammar does not allow."""


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda m: m[1], text)


@dataclass
class Turn:
    role: str
    text: str
    start: int  # where the written text starts and ends in the rendered string
    end: int


def parse(rendered: str, at: int = 0) -> list[Turn]:
    """Turns of a rendered string, in one pass from left to right."""
    out = []
    while at < len(rendered):
        if not rendered.startswith(OPEN, at):
            raise NotReadable(f"no turn begins at {at}")
        colon = rendered.find(":", at)
        role = _ROLE_UNESCAPE.sub(lambda m: _ROLE_BACK[m[1]], rendered[at + len(OPEN) : colon]) if colon >= 0 else ""
        escaped = rendered.startswith(ESCAPED_HEAD_END, colon)
        if colon < 0 or not escaped and not rendered.startswith(HEAD_END, colon):
            raise NotReadable(f"no header ends after {at}")
        start = colon + len(ESCAPED_HEAD_END if escaped else HEAD_END)
        end = rendered.find(CLOSE, start)
        while end >= 0 and escaped and (end - len(rendered[start:end].rstrip("\\")) - start) % 2:
            end = rendered.find(CLOSE, end + 1)  # an odd number of backslashes: the control string is text
        if end < 0:
            raise NotReadable(f"no turn ends after {start}")
        text = rendered[start:end]
        out.append(Turn(role, unescape(text) if escaped else text, start, end))
        at = end + len(CLOSE)
    return out


def render_turn(role: str, text: str) -> tuple[str, Turn]:
    """A turn as written, and as read back from that."""
    name = _ROLE_ESCAPE.sub(lambda m: _ROLE_LETTERS[m[0]], role)
    for head, body in ((HEAD_END, text), (ESCAPED_HEAD_END, escape(text))):
        if head == HEAD_END and any(c in text for c in CONTROL):
            continue
        rendered = OPEN + name + head + body + CLOSE
        try:
            back = parse(rendered)
        except NotReadable:
            continue
        if len(back) == 1 and (back[0].role, back[0].text) == (role, text):
            return rendered, back[0]
    raise NotReadable("the template cannot hold this turn")


@dataclass
class Formatted:
    """What has been written of one conversation; texts need not be held together for the digests."""

    conv_id: int | None
    n_turns: int = 0
    chars: int = 0
    loss_chars: int = 0
    turns: object = field(default_factory=hashlib.sha256)
    loss: object = field(default_factory=hashlib.sha256)
    spans: list[tuple[int, int]] | None = field(default_factory=list)

    def add(self, role: str, text: str) -> str:
        rendered, back = render_turn(role, text)
        self.n_turns += 1
        self.turns.update(f"{back.role}\n{back.text}\n".encode())
        if back.role == LOSS_ROLE:
            self.loss.update(back.text.encode())
            self.loss_chars += len(back.text)
            if self.spans is not None:
                self.spans.append((self.chars + back.start, self.chars + back.end))
        self.chars += len(rendered)
        return rendered


PARTS = "conv_id bigint, part bigint, rendered string"
DIGESTS = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
SPANS = ", loss_spans array<struct<start: bigint, end: bigint>>"


def _ordered(rows: DataFrame) -> DataFrame:
    """Whole conversations in the order of their turns; ties by role and text."""
    rows = rows.select(F.col("conv_id").cast("bigint"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")


def digest_conversations(rows: DataFrame, spans: bool = True) -> DataFrame:
    """A row for each conv_id of ``rows`` (conv_id, turn, role, text; others are ignored): digests of the turns
    and of the text under the loss mask, both read back from the rendered turns, the rendered length, and, with
    ``spans``, the mask as spans of code points of the rendered conversation.

    Turns go in the order of turn, then role, then text; a null turn comes first, null roles and texts count
    as empty, a null conv_id is a conversation of its own, and repeated rows are turns of their own. A task
    streams over turns: of a conversation it holds digests, never the texts; with ``spans`` also a span for each turn
    under the mask. An empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: Formatted | None = None
        done: list[Formatted] = []

        def out():
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            columns = [
                pa.array([f.conv_id for f in done], pa.int64()),
                pa.array([f.n_turns for f in done], pa.int64()),
                pa.array([f.turns.hexdigest() for f in done], pa.string()),
                pa.array([f.loss_chars for f in done], pa.int64()),
                pa.array([f.loss.hexdigest() for f in done], pa.string()),
                pa.array([f.chars for f in done], pa.int64()),
            ]
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            if spans:
                columns.append(pa.array([[{"start": a, "end": b} for a, b in f.spans] for f in done], kind))
                names.append("loss_spans")
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            for conv_id, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if current is None or conv_id != current.conv_id:
                    if current is not None:
                        done.append(current)
                    current = Formatted(conv_id, spans=[] if spans else None)
                current.add(role, text)
            if done:
                yield out()
                done = []
        if current is not None:
            done.append(current)
            yield out()

    return _ordered(rows).mapInArrow(run, DIGESTS + SPANS * spans)


def format_conversations(rows: DataFrame) -> DataFrame:
    """(conv_id, part, rendered): the written turns of each conversation, part by part from 0; joined in order
    they are the rendered conversation. The same rules as in ``digest_conversations``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, part = None, -1
        for batch in batches:
            out = []
            for conv_id, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                part = part + 1 if part >= 0 and conv_id == last else 0
                last = conv_id
                out.append((conv_id, part, render_turn(role, text)[0]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string()))], ["conv_id", "part", "rendered"]
            )

    return _ordered(rows).mapInArrow(run, PARTS)
