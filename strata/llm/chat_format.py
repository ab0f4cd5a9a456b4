"""Chat formatting by incremental black-box rendering.

A template is any function from turns to text. Successive prefixes of a
conversation are rendered and consecutive outputs compared: what the next turn
adds is its segment. Rendering the same prefix with a probe text in place of
the turn's own shows where in the segment the text lies. A template whose
output for a longer prefix does not begin with its output for the shorter one
rewrites history, and is reported instead of being given wrong spans.

The formatted output is one row per turn. A task holds the turns of one
conversation, for a black box has to be given them all, and every prefix is
rendered from the first turn on, however long the conversation: nothing less
shows what a black box does there. That costs the square of its turns.

A template whose turns depend on their last neighbours alone may say so
(``render.look_back = k``). Its prefixes hold the last k turns from the first
turn on, again whatever the length, and each conversation's output is held
against one rendering of the whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import groupby
from operator import itemgetter
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str, str]
Render = Callable[[Sequence[Turn]], str]

PROBE = "probe"
# Whether a template looks local is observed over so many turns and with windows of so many; no result hangs on it.
FULL_PREFIX = 256
LOOK_BACK = 32


# --- locating turns in the output of a black box ----------------------------------------------

@dataclass(frozen=True)
class Segment:
    """What a turn added, and where its text lies in that."""

    text: str
    start: int
    end: int
    rewrites: bool


class IncrementalRenderer:
    """Feeds turns to a template and yields their segments.

    A segment is found from the prefix of all turns before it, or of the last
    ``render.look_back`` turns where the template declares that number. The
    length of the conversation changes nothing in that. ``local`` says whether
    the last turns alone gave every segment so far, as a declaration would
    claim; it is declared or observed, and decides nothing.
    """

    def __init__(self, render: Render):
        self.render = render
        self.look_back: int | None = getattr(render, "look_back", None)
        self.turns: list[Turn] = []
        self.whole: list[Turn] = []
        self.proven = 0
        self.local = True
        self.before = render([])
        self.head = self.before
        self.length = 0
        self.digest = hashlib.sha256()
        self._count(self.head)

    @property
    def seen(self) -> int:
        return len(self.whole)

    def add(self, role: str, text: str) -> Segment:
        segment, now, follows = self._segment(self.before, self.turns, role, text)
        if self.look_back is None:
            self.local &= follows
            if self.local and self.seen < FULL_PREFIX:
                self.local = self.seen < LOOK_BACK or self._near(role, text) == segment
            self.proven += 1
        self.whole.append((role, text))
        self.turns.append((role, text))
        if self.look_back is not None and len(self.turns) > self.look_back:
            self.turns = self.whole[self.seen - self.look_back:]
            now = self.render(self.turns)
        self.before = now
        self._count(segment.text)
        return segment

    def segments(self, turns: Iterable[Turn]) -> Iterator[tuple[str, Segment]]:
        """(role, segment) of every turn of a conversation."""
        for role, text in turns:
            yield role, self.add(role, text)
        if self.look_back is not None:
            self._prove()

    def _prove(self) -> None:
        """Hold the segments of a template that declares its look-back against its output for the whole conversation."""
        made = self.render(self.whole)
        if len(made) != self.length or _digest(made) != self.digest.digest():
            raise ValueError(f"the template looks back further than the {self.look_back} turns it declares")
        self.proven = self.seen

    def _count(self, text: str) -> None:
        self.length += len(text)
        self.digest.update(text.encode("utf-8", "surrogatepass"))

    def _near(self, role: str, text: str) -> Segment | None:
        """The segment as the last turns give it, None where they give none."""
        # Some templates want the first role first, and refuse anything else with an error of their own.
        near = self.whole[-LOOK_BACK:]
        opens = next((i for i, (r, _) in enumerate(near) if r == self._first_role()), 0)
        try:
            segment, _, follows = self._segment(self.render(near[opens:]), near[opens:], role, text)
        except Exception:  # noqa: BLE001 - a black box
            return None
        return segment if follows else None

    def _first_role(self) -> str:
        """The role that opens the conversation, after a system turn if there is one."""
        return self.whole[1 if self.whole[0][0] == "system" else 0][0]

    def _segment(self, before: str, turns: list[Turn], role: str, text: str) -> tuple[Segment, str, bool]:
        """(what the turn adds, the output with it, whether that begins with the output before)."""
        now = self.render([*turns, (role, text)])
        probe = self.render([*turns, (role, PROBE)])
        if not now.startswith(before) or not probe.startswith(before):
            return Segment(now, 0, 0, True), now, False
        added, probed = now[len(before):], probe[len(before):]
        lead, mark, tail = probed.partition(PROBE)
        if not mark or PROBE in tail or not added.startswith(lead) or not added.endswith(tail) \
                or len(added) < len(lead) + len(tail):
            return Segment(added, 0, 0, True), now, True
        return Segment(added, len(lead), len(added) - len(tail), False), now, True


def _digest(text: str) -> bytes:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest()


# --- a template -------------------------------------------------------------------------------

_CONTROL = re.compile(r"([<\[])(\\*)(/?s>|/?INST\]|/?SYS\]|/?ROLE)")
_ESCAPED = re.compile(r"([<\[])\\(\\*)(/?s>|/?INST\]|/?SYS\]|/?ROLE)")
_MARKS = {"user": ("<s>[INST] ", " [/INST]"), "assistant": (" ", "</s>"), "system": ("<s>[SYS] ", " [/SYS]")}


def escape(text: str) -> str:
    """Put a backslash into every control string; one more where some are already."""
    return _CONTROL.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def render_instructions(turns: Sequence[Turn]) -> str:
    """Instruction marks around each turn; texts hold no unescaped control string."""
    out = []
    for role, text in turns:
        lead, tail = _MARKS.get(role) or (f"<s>[ROLE {quote(role, safe='')}] ", " [/ROLE]")
        out.append(lead + escape(text) + tail)
    return "".join(out)


# A turn is written the same whatever comes before it; the turn before is rendered too and must come out unchanged.
render_instructions.look_back = 1


_TURN = re.compile(r"<s>\[INST\] (?P<user>.*?) \[/INST\]|<s>\[SYS\] (?P<system>.*?) \[/SYS\]|"
                   r"<s>\[ROLE (?P<name>[^\]]*)\] (?P<other>.*?) \[/ROLE\]| (?P<assistant>.*?)</s>", re.DOTALL)


def read_instructions(formatted: str) -> list[Turn]:
    """The turns of a text that :func:`render_instructions` made."""
    turns, at = [], 0
    while at < len(formatted):
        match = _TURN.match(formatted, at)
        if not match:
            raise ValueError(f"no turn begins at {at}")
        at = match.end()
        if match["name"] is not None:
            turns.append((unquote(match["name"]), unescape(match["other"])))
        else:
            role = next(r for r in _MARKS if match[r] is not None)
            turns.append((role, unescape(match[role])))
    return turns


# --- operators --------------------------------------------------------------------------------

def _grouped(batches: Iterator[pa.RecordBatch], columns: Sequence[str]) -> Iterator[tuple]:
    """(conversation changed, values) row by row over sorted batches."""
    last: object = ...
    for batch in batches:
        for values in zip(*(batch.column(c).to_pylist() for c in columns)):
            yield values[0] != last, values
            last = values[0]


_ROW_BATCH = 2000


def _flushed(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) >= _ROW_BATCH:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def format_conversations(conversations: DataFrame, render: Render = render_instructions,
                         loss_roles: Sequence[str] = ("assistant",)) -> DataFrame:
    """One row per turn: conv_id, ``seq`` (0, 1, ...), ``segment``, ``loss``, ``text_start``, ``text_end``, ``rewrites``.

    The segments of a conversation in ``seq`` order are its formatted text;
    ``loss`` says whether ``[text_start, text_end)`` of the segment is under
    the loss mask. Turns come in the order of (turn, role, text), nulls first.
    A null text or role counts as empty. Rows with a null conv_id are one
    conversation. Repeated rows are turns of their own. An empty table gives
    an empty result; other columns are ignored.
    """
    dealt = (conversations.select("conv_id", F.col("turn").alias("turn"), "role", "text").repartition("conv_id")
             .sortWithinPartitions("conv_id", "turn", "role", "text"))
    kind = conversations.schema["conv_id"].dataType
    schema = pa.schema([("conv_id", pa.int64()), ("seq", pa.int64()), ("segment", pa.string()), ("loss", pa.bool_()),
                        ("text_start", pa.int64()), ("text_end", pa.int64()), ("rewrites", pa.bool_())])
    if kind.simpleString() not in ("bigint", "int"):
        raise ValueError("conv_id is an integer")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        values = (v for _, v in _grouped(batches, ("conv_id", "role", "text")))
        for conv, group in groupby(values, key=itemgetter(0)):
            renderer = IncrementalRenderer(render)
            made = renderer.segments((role or "", text or "") for _, role, text in group)
            for seq, (role, segment) in enumerate(made):
                head = renderer.head if seq == 0 else ""
                yield {"conv_id": conv, "seq": seq, "segment": head + segment.text,
                       "loss": role in loss_roles and not segment.rewrites, "text_start": segment.start + len(head),
                       "text_end": segment.end + len(head), "rewrites": segment.rewrites}

    return dealt.mapInArrow(lambda batches: _flushed(rows(batches), schema),
                            "conv_id bigint, seq bigint, segment string, loss boolean, text_start bigint, text_end bigint, "
                            "rewrites boolean")


def read_formatted(formatted: DataFrame, read: Callable[[str], list[Turn]] = read_instructions,
                   unescape_text: Callable[[str], str] = unescape) -> DataFrame:
    """Read formatted conversations back: one row per conversation.

    ``n_turns``, ``turns_sha256`` (role, newline, text, newline per turn, from
    the marks), ``loss_chars`` and ``loss_sha256`` (the unescaped text under
    the loss mask, from the spans), ``formatted_chars``, ``rewrites``.
    Digests are fed turn by turn, so a long conversation takes no more memory
    than a short one.
    """
    dealt = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "seq")
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
                        ("rewrites", pa.bool_())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        row = turns = loss = None

        def done() -> dict:
            return row | {"turns_sha256": turns.hexdigest(), "loss_sha256": loss.hexdigest()}

        names = ("conv_id", "segment", "loss", "text_start", "text_end", "rewrites")
        for changed, (conv, segment, masked, start, end, rewrites) in _grouped(batches, names):
            if changed:
                if row is not None:
                    yield done()
                row = {"conv_id": conv, "n_turns": 0, "loss_chars": 0, "formatted_chars": 0, "rewrites": False}
                turns, loss = hashlib.sha256(), hashlib.sha256()
            for role, text in ([] if rewrites else read(segment)):
                row["n_turns"] += 1
                turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            if masked:
                text = unescape_text(segment[start:end])
                row["loss_chars"] += len(text)
                loss.update(text.encode("utf-8", "surrogatepass"))
            row["formatted_chars"] += len(segment)
            row["rewrites"] |= rewrites
        if row is not None:
            yield done()

    return dealt.mapInArrow(lambda batches: _flushed(rows(batches), schema),
                            "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
                            "formatted_chars bigint, rewrites boolean")
