"""Repair of conversation structure by a checkpointed dynamic program.

A conversation's rows become a list of roles that reads ``(s?(ua)+)?``, by the
cheapest edits: keep a row (0), give it the role user or assistant (2), delete
it (3, and required where it is blank or repeats an earlier one), insert an
empty user or assistant row (2). A truncated row that stays costs 1. Of equally
cheap edits those whose initials are least in ASCII order are taken.

The grammar has four states, so what lies ahead of a place is a vector of four
costs. The vectors are found from the end backwards and the edits emitted
from the start forwards, always the least edit that is tight, that is, after
which the cost ahead falls by just its price. Instead of all vectors only those
at checkpoints are kept, about the square root of the rows apart, and those
between two checkpoints are computed again when the walk gets there.

On Spark the same scheme spans tasks. Rows are sorted by range, so that a
long conversation is spread over tasks, and cut into blocks. A block's effect on
a vector is a 4 x 4 matrix of costs; a narrow stream over the blocks, last
first, multiplies them and leaves a checkpoint at the end of every block. A second
stream, over blocks and checkpoints in order, walks forward through one
block at a time, whatever the conversation's length.

Defined results: rows are taken by turn (nulls first), role and text; null
roles and texts are one space. Equal rows of one turn stand side by side, and
all but the first are duplicates; they are one entry with a number. A null id is
a conversation of its own. A role that begins otherwise, or is empty, fits nowhere as it
is. Ids without rows (see ``ids``) have no edits. Very
long texts pass whole, a block holds few of them. Other columns are ignored.
An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import isqrt

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from strata.llm.common import materialise

# The grammar: nothing yet, after a system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
NEXT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
# The one role of the two that an inserted or renamed row can have in each state.
TURN = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
LEGAL = frozenset(("su", "ua", "au"))
RENAME, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
NEVER = 1 << 60
SPACES = " \\t\\n\\u000B\\f\\r"

# Faults of an entry.
SOUND, CUT, REPEATED, BLANK = range(4)

Vector = tuple[int, int, int, int]


@dataclass(frozen=True)
class RepairParams:
    """Bounds of a block: entries, and characters of their texts."""

    block_rows: int = 4096
    block_chars: int = 4_000_000


# --- the dynamic program ----------------------------------------------------------------------

def _with_inserts(at: list[int]) -> Vector:
    user = min(at[USER], INSERT + at[ASSISTANT])
    assistant = min(at[ASSISTANT], INSERT + at[USER])
    return min(at[START], INSERT + user), min(at[SYSTEM], INSERT + user), user, assistant


AT_END: Vector = _with_inserts([0, NEVER, NEVER, 0])


def back(initial: str, fault: int, copies: int, after: Vector) -> Vector:
    """The costs before an entry, from those after it."""
    if fault >= REPEATED:
        drop = DELETE * copies
        return after[0] + drop, after[1] + drop, after[2] + drop, after[3] + drop
    stay = TRUNCATED * (fault == CUT)
    costs = []
    for state in range(STATES):
        best = min(DELETE + after[state], RENAME + stay + after[TURN[state]])
        kept = NEXT[state].get(initial)
        costs.append(best if kept is None else min(best, stay + after[kept]))
    before = _with_inserts(costs)
    if copies == 1:
        return before
    extra = DELETE * (copies - 1)
    return before[0] + extra, before[1] + extra, before[2] + extra, before[3] + extra


def edits(initials: list[str], faults: list[int], copies: list[int], state: int, end: Vector) -> Iterator[tuple[int, str, int]]:
    """The least tight edits of a block: entry (of an inserted row, the one it precedes), initial, state after it.

    ``end`` is the vector after the block. Vectors are kept at every isqrt(n)-th place only and found again
    between two of them.
    """
    n = len(initials)
    stride = isqrt(n) + 1
    checkpoints = {n: end}
    vector = end
    for i in range(n, 0, -1):
        if i % stride == 0:
            checkpoints[i] = vector
        vector = back(initials[i - 1], faults[i - 1], copies[i - 1], vector)
    for low in range(0, n, stride):
        high = min(low + stride, n)
        ahead = [checkpoints[high]]
        for i in range(high, low, -1):
            ahead.append(back(initials[i - 1], faults[i - 1], copies[i - 1], ahead[-1]))
        ahead.reverse()
        for i in range(low, high):
            here, after, fault, count = ahead[i - low], ahead[i - low + 1], faults[i], copies[i]
            rest = DELETE * (count - 1)
            stay = TRUNCATED * (fault == CUT)
            while True:
                if here[state] == DELETE + rest + after[state]:
                    yield i, "D" * count, state
                    break
                if here[state] == INSERT + here[TURN[state]]:
                    state = TURN[state]
                    yield i, "I", state
                    continue
                kept = NEXT[state].get(initials[i])
                if kept is not None and here[state] == stay + rest + after[kept]:
                    state = kept
                    yield i, "K" + "D" * (count - 1), state
                    break
                state = TURN[state]
                yield i, "R" + "D" * (count - 1), state
                break


def block_matrix(initials: list[str], faults: list[int], copies: list[int]) -> list[int]:
    """Costs from every state before a block to every state after it, row by row."""
    columns = []
    for to in range(STATES):
        vector: Vector = tuple(0 if s == to else NEVER for s in range(STATES))
        for i in range(len(initials) - 1, -1, -1):
            vector = back(initials[i], faults[i], copies[i], vector)
        columns.append(vector)
    return [min(NEVER, columns[to][state]) for state in range(STATES) for to in range(STATES)]


def through(matrix: list[int], after: Vector) -> Vector:
    """The vector before a block. Inserts right before the block's end are those of what follows."""
    return tuple(min(matrix[STATES * s + to] + after[to] for to in range(STATES)) for s in range(STATES))


# --- the Spark job ----------------------------------------------------------------------------

def _stripped(text: str) -> Column:
    return F.expr(f"rtrim('{SPACES}', `{text}`)")


def find_faults(rows: DataFrame) -> DataFrame:
    """An entry for each distinct (id, turn, role, text): its ``copies`` and its ``fault``.

    Equal rows are counted before the shuffle. Whether a role and text were seen earlier is told by the first turn
    that has them, which is one row for each, joined back.
    """
    entries = (rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
                           F.coalesce("text", F.lit(" ")).alias("text"))
               .groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
               .withColumn("last", F.right(_stripped("text"), F.lit(1))).withColumn("digest", F.md5("text")))
    entries = materialise(rows.sparkSession, entries, "conversation-entries")
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    firsts = (entries.where(F.col("last") != "").groupBy("conv_id", "role", "digest").agg(F.min(place).alias("first"))
              .select(F.col("conv_id").alias("first_id"), F.col("role").alias("first_role"), F.col("digest").alias("first_digest"), "first"))
    same = (F.col("conv_id").eqNullSafe(F.col("first_id")) & (F.col("role") == F.col("first_role"))
            & (F.col("digest") == F.col("first_digest")))
    fault = (F.when(F.col("last") == "", BLANK).when(place > F.col("first"), REPEATED)
             .when(~F.col("last").isin(".", "!", "?"), CUT).otherwise(SOUND))
    return entries.join(firsts, same, "left").select("conv_id", "turn", "role", "text", "copies", fault.cast("int").alias("fault"))


_BLOCK = ("part int, seq bigint, roles array<string>, texts array<string>, copies array<bigint>, faults array<int>, "
          "min_turn bigint, max_turn bigint, turns bigint, vector array<bigint>")


@dataclass
class _Block:
    roles: list[str] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    copies: list[int] = field(default_factory=list)
    faults: list[int] = field(default_factory=list)
    chars: int = 0
    min_turn: int | None = None
    max_turn: int | None = None
    turns: int = 0

    def add(self, turn: int | None, role: str, text: str, copies: int, fault: int) -> None:
        self.roles.append(role)
        self.texts.append(text)
        self.copies.append(copies)
        self.faults.append(fault)
        self.chars += len(text)
        if turn is not None and turn != self.max_turn:
            self.min_turn = turn if self.min_turn is None else self.min_turn
            self.max_turn, self.turns = turn, self.turns + 1


def _schema(entries: DataFrame, rest: str) -> T.StructType:
    return T.StructType([T.StructField("conv_id", entries.schema["conv_id"].dataType), *T._parse_datatype_string(rest).fields])


def _blocks(entries: DataFrame, params: RepairParams) -> DataFrame:
    """Sorted entries in blocks of one conversation each, with the block's matrix as its ``vector``."""
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("role")]
    fields = _schema(entries, _BLOCK)
    target = to_arrow_schema(fields)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        block, held = _Block(), None

        def emit() -> pa.RecordBatch:
            initials = [r[:1] for r in block.roles]
            row = (held, part, seq, block.roles, block.texts, block.copies, block.faults, block.min_turn, block.max_turn,
                   block.turns, block_matrix(initials, block.faults, block.copies))
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, target)], schema=target)

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "copies", "fault")]
            for conv_id, *entry in zip(*columns):
                if block.roles and (conv_id != held or len(block.roles) >= params.block_rows or block.chars >= params.block_chars):
                    yield emit()
                    block, seq = _Block(), seq + 1
                held = conv_id
                block.add(*entry)
        if block.roles:
            yield emit()

    ranged = entries.repartitionByRange(*order, F.substring("text", 1, 64)).sortWithinPartitions(*order, F.asc("text"))
    return ranged.mapInArrow(cut, fields)


def _checkpoints(blocks: DataFrame) -> DataFrame:
    """For every block the vector after it, by a stream over the blocks' matrices, last first."""
    fields = _schema(blocks, "part int, seq bigint, vector array<bigint>")
    target = to_arrow_schema(fields)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, vector, begun = None, AT_END, False
        for batch in batches:
            ids = batch.column("conv_id").to_pylist()
            vectors = []
            for conv_id, matrix in zip(ids, batch.column("vector").to_pylist()):
                if not begun or conv_id != held:
                    held, vector, begun = conv_id, AT_END, True
                vectors.append(list(vector))
                vector = through(matrix, vector)
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("part"), batch.column("seq"),
                                              pa.array(vectors, target.field("vector").type)], schema=target)

    return (blocks.select("conv_id", "part", "seq", "vector").repartition("conv_id")
            .sortWithinPartitions(F.asc_nulls_first("conv_id"), F.desc("part"), F.desc("seq")).mapInArrow(scan, fields))


class _Walk:
    """A conversation's state while its blocks go by."""

    def __init__(self, conv_id: object) -> None:
        self.conv_id = conv_id
        self.state, self.end = START, AT_END
        self.audit: list[str] = []
        self.hash, self.rows, self.place = hashlib.sha256(), 0, 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.cost = self.turns = 0
        self.min_turn = self.max_turn = None
        self.last = None

    def _put(self, role: str, text: str) -> tuple[str, str]:
        self.hash.update((("\n" if self.rows else "") + f"{role}:{text}").encode())
        self.rows += 1
        return role, text

    def step(self, block: dict) -> Iterator[tuple[str, str, str]]:
        """Edits of the next block: initial, role and text, of the row as it was where it is deleted."""
        roles, texts, copies, faults = block["roles"], block["texts"], block["copies"], block["faults"]
        for role, count, fault in zip(roles, copies, faults):
            initial = role[:1]
            self.blank += count * (fault == BLANK)
            self.duplicate += count if fault == REPEATED else count - 1 if fault != BLANK else 0
            self.truncated += fault == CUT
            self.illegal += (count - 1) * (initial * 2 not in LEGAL) + (self.last is not None and self.last + initial not in LEGAL)
            self.last = initial
        if block["min_turn"] is not None:
            self.min_turn = block["min_turn"] if self.min_turn is None else self.min_turn
            self.turns += block["turns"] - (block["min_turn"] == self.max_turn)
            self.max_turn = block["max_turn"]
        for i, made, state in edits([r[:1] for r in roles], faults, copies, self.state, self.end):
            self.state = state
            self.audit.append(made)
            first = made[0]
            self.cost += {"K": 0, "R": RENAME, "D": DELETE, "I": INSERT}[first] + DELETE * (len(made) - 1)
            if first in "KR":
                self.cost += TRUNCATED * (faults[i] == CUT)
                yield (first, *self._put(roles[i] if first == "K" else ROLE[state], texts[i]))
            elif first == "I":
                yield (first, *self._put(ROLE[state], ""))
            for _ in range(len(made) - (first != "D")):
                yield "D", roles[i], texts[i]

    def finish(self) -> Iterator[tuple[str, str, str]]:
        while self.state not in (START, ASSISTANT):
            self.state = TURN[self.state]
            self.audit.append("I")
            self.cost += INSERT
            yield ("I", *self._put(ROLE[self.state], ""))

    def report(self) -> tuple:
        gaps = 0 if self.min_turn is None else self.max_turn - self.min_turn + 1 - self.turns
        return (self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost,
                "".join(self.audit), self.hash.hexdigest())


_REPORT = ("gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, "
           "repaired_sha256 string")
_EDITS = "place bigint, edit string, role string, text string"
_MARK, _VECTOR, _ROWS = range(3)


def _walked(rows: DataFrame, ids: DataFrame | None, params: RepairParams, as_edits: bool) -> DataFrame:
    blocks = materialise(rows.sparkSession, _blocks(find_faults(rows), params), "conversation-blocks")
    parts = [blocks.withColumn("kind", F.lit(_ROWS)), _checkpoints(blocks).withColumn("kind", F.lit(_VECTOR))]
    if ids is not None:
        parts.append(ids.select("conv_id").distinct().select("conv_id", F.lit(-1).alias("part"), F.lit(_MARK).alias("kind")))
    stream = parts[0]
    for part in parts[1:]:
        stream = stream.unionByName(part, allowMissingColumns=True)
    fields = _schema(blocks, _EDITS if as_edits else _REPORT)
    target = to_arrow_schema(fields)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Walk | None = None
        out: list[tuple] = []
        chars = 0

        def put(found: Iterator[tuple[str, str, str]]) -> int:
            added = 0
            for edit, role, text in found:
                if as_edits:
                    out.append((now.conv_id, now.place, edit, role, text))
                    added += len(text)
                now.place += 1
            return added

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, target)], schema=target)

        for batch in batches:
            for at in range(len(batch)):
                row = batch.slice(at, 1).to_pylist()[0]
                if now is None or row["conv_id"] != now.conv_id:
                    if now is not None:
                        chars += put(now.finish())
                        if not as_edits:
                            out.append(now.report())
                    now = _Walk(row["conv_id"])
                if row["kind"] == _VECTOR:
                    now.end = tuple(row["vector"])
                elif row["kind"] == _ROWS:
                    chars += put(now.step(row))
                if len(out) >= 4096 or chars >= params.block_chars:
                    chars = 0
                    yield flush()
        if now is not None:
            put(now.finish())
            if not as_edits:
                out.append(now.report())
        if out:
            yield flush()

    return (stream.repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), "part", "seq", "kind")
            .mapInArrow(walk, fields))


def repair_edits(rows: DataFrame, params: RepairParams = RepairParams()) -> DataFrame:
    """All edits in order: ``conv_id``, ``place``, ``edit`` (K, R, D, I), ``role`` and ``text``; rows of D are those dropped."""
    return _walked(rows, None, params, as_edits=True)


def repair_reports(rows: DataFrame, ids: DataFrame | None = None, params: RepairParams = RepairParams()) -> DataFrame:
    """A row per conversation (and per id of ``ids``): faults, the edits' cost and initials, and a digest of the repaired rows."""
    return _walked(rows, ids, params, as_edits=False)


def damage(rows: DataFrame) -> DataFrame:
    """Rows with faults that follow from id and turn alone, to repair; null roles and texts become one space."""
    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fault = F.crc32(F.encode(F.concat(shown("conv_id"), F.lit(":"), shown("turn")), "UTF-8")) % 20
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate(shown("text"), ".!?", "")).otherwise(shown("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(shown("role"))
    return (rows.select("conv_id", "turn", "role", "text", fault.alias("fault")).where(F.col("fault") != 0)
            .select("conv_id", "turn", role.alias("role"), text.alias("text"),
                    F.explode(F.sequence(F.lit(1), F.when(F.col("fault") == 3, 2).otherwise(1))).alias("copy")).drop("copy"))
