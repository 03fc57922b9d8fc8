"""Conversation structure repair: cheapest edits by dynamic programming streamed over sorted turns."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import session

#: White space of this operator: blank, and tab to carriage return.
BLANKS = "\x20\x09-\x0d"
#: Costs of the edits, and of leaving a truncated row in.
RENAME, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

# The legal role initials are (s?(ua)+)?. What is written so far leaves one of four states:
START, SYSTEM, USER, ASSISTANT = range(4)
#: Where an initial leads from each state; an initial that is not listed is illegal there.
STEPS = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: The one role an inserted or renamed row may have in each state, and the state after it.
FORCED = (("user", USER), ("user", USER), ("assistant", ASSISTANT), ("user", USER))
#: Cost of ending in each state: the rows still to be inserted.
ENDING = (0, 2 * INSERT, INSERT, 0)
#: Edits in the order in which ties are broken; a backpointer is an index into this text.
EDITS = "DIKR"
#: Role pairs that may stand side by side.
PAIRS = {"su", "ua", "au"}


def damage(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, turn, role, text, gone``: rows damaged by the CRC-32 of ``conv_id:turn`` modulo 20.

    0 drops the row (``gone``: it stays to tell that the conversation exists), 1 empties its text, 2 removes
    ``[.!?]``, 3 repeats the row, 4 makes it a user's. A null role or text, and a null in the checked name, is one
    space; null ids and turns themselves stay null.
    """
    space = F.lit(" ")
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in (conv_col, turn_col)])
    rows = turns.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), space).alias("role"),
        F.coalesce(F.col(text_col), space).alias("text"),
        F.pmod(F.crc32(name.cast("binary")), F.lit(20)).alias("kind"),
    )
    kind = F.col("kind")
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1)))
    return rows.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        (kind == 0).alias("gone"),
        times.alias("copy"),
    ).drop("copy")


def _fault(text: Column, copy: Column) -> Column:
    bare = F.regexp_replace(text, rf"[{BLANKS}]+$", "")
    return (
        F.when(bare == "", "blank")
        .when(copy > 1, "duplicate")
        .when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), "truncated")
        .otherwise("")
    )


def _relaxed(costs: list[int]) -> list[int]:
    """Costs with insertions before the next row allowed: two at most, as three come back to a state met before."""
    for _ in range(2):
        costs = [min(c, INSERT + costs[after]) for c, (_, after) in zip(costs, FORCED)]
    return costs


def _choice(costs: tuple[int, ...], initial: str, fault: str) -> tuple[tuple[int, ...], int]:
    """One row of the programme, from its end: ``(costs before, backpointers)``, costs less the least of them.

    ``costs`` holds what the rows behind cost from each state. The backpointers are the first edit from each
    state, two bits each in one byte: the first in ``EDITS`` of the cheapest, so that the edits in order are the
    least text among the cheapest.
    """
    extra = TRUNCATED if fault == "truncated" else 0
    options = []
    for state in range(4):
        own = {"D": DELETE + costs[state]}
        if fault not in ("blank", "duplicate"):
            if initial in STEPS[state]:
                own["K"] = extra + costs[STEPS[state][initial]]
            own["R"] = RENAME + extra + costs[FORCED[state][1]]
        options.append(own)
    best = _relaxed([min(own.values()) for own in options])
    moves = 0
    for state, own in enumerate(options):
        own["I"] = INSERT + best[FORCED[state][1]]
        moves |= EDITS.index(min(e for e, cost in own.items() if cost == best[state])) << 2 * state
    least = min(best)
    return tuple(c - least for c in best), moves


class Programme:
    """``_choice`` with its answers remembered: costs relative to their least are few, so the table stays small."""

    def __init__(self):
        self.known: dict = {}

    def row(self, costs: tuple[int, ...], initial: str, fault: str) -> tuple[tuple[int, ...], int]:
        key = costs, initial if initial in ("s", "u", "a") else "", fault
        if key not in self.known:
            self.known[key] = _choice(*key)
        return self.known[key]


def _backwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows from the last to the first of each conversation, with the backpointers of each row.

    Only the costs of four states are carried from row to row and from batch to batch; the
    backpointers leave with their row.
    """
    programme, current, begun, costs = Programme(), None, False, ENDING
    for batch in batches:
        found = []
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "role", "fault", "gone")]
        for conv, role, fault, gone in zip(*columns):
            if not begun or conv != current:
                begun, current, costs = True, conv, ENDING
            if gone:
                found.append(0)
                continue
            costs, moves = programme.row(costs, role[:1], fault)
            found.append(moves)
        names = ["conv_id", "turn", "role", "text", "copy", "fault", "gone"]
        yield pa.RecordBatch.from_arrays([*map(batch.column, names), pa.array(found, pa.int16())], names=[*names, "moves"])


class _Conversation:
    """What is known of one conversation while its rows pass by in order."""

    def __init__(self, conv):
        self.conv = conv
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.first = self.last = None
        self.turns = self.illegal = self.cost = 0
        self.before: str | None = None
        self.state, self.edits = START, bytearray()
        self.text, self.empty = hashlib.sha256(), True

    def _write(self, role: str, text: str) -> None:
        self.text.update(f"{role}:{text}".encode() if self.empty else f"\n{role}:{text}".encode())
        self.empty = False

    def _insert(self) -> None:
        role, self.state = FORCED[self.state]
        self._write(role, "")
        self.edits += b"I"
        self.cost += INSERT

    def row(self, turn, role: str, text: str, fault: str, moves: int) -> None:
        if turn is not None:
            self.first = turn if self.first is None else self.first
            self.turns += turn != self.last
            self.last = turn
        if fault:
            self.faults[fault] += 1
        if self.before is not None and self.before + role[:1] not in PAIRS:
            self.illegal += 1
        self.before = role[:1]
        while (edit := EDITS[moves >> 2 * self.state & 3]) == "I":
            self._insert()
        self.edits += edit.encode()
        if edit == "D":
            self.cost += DELETE
            return
        self.cost += TRUNCATED * (fault == "truncated")
        if edit == "K":
            self.state = STEPS[self.state][role[:1]]
        else:
            role, self.state = FORCED[self.state]
            self.cost += RENAME
        self._write(role, text)

    def closed(self) -> tuple:
        while self.state in (SYSTEM, USER):
            self._insert()
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return (self.conv, gaps, *self.faults.values(), self.illegal, self.cost, self.edits.decode(), self.text.hexdigest())


SCHEMA = (
    "conv_id {conv}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)


def _forwards(conv_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in SCHEMA.split(", ")]
        types = [conv_type, *[pa.int64()] * 6, pa.string(), pa.string()]

        def out(done: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)

        open_one: _Conversation | None = None
        for batch in batches:
            done = []
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "fault", "moves", "gone")]
            for conv, turn, role, text, fault, moves, gone in zip(*columns):
                if open_one is None or conv != open_one.conv:
                    if open_one is not None:
                        done.append(open_one.closed())
                    open_one = _Conversation(conv)
                if not gone:
                    open_one.row(turn, role, text, fault, moves)
            if done:
                yield out(done)
        if open_one is not None:
            yield out([open_one.closed()])

    return run


def repair(rows: DataFrame) -> DataFrame:
    """Faults, cheapest edits and digest of the repaired text of each conversation in ``conv_id, turn, role, text, gone``.

    Edits: Keep, Delete, Insert (empty text), Rerole; what remains must have the role initials ``(s?(ua)+)?``.
    ``audit`` is the edits' initials in order: of the cheapest the least in ASCII, which also fixes the result.

    One exchange by conversation; then three sorts of its partitions, which spill. The first finds repeated rows,
    the second hands the rows backwards to the dynamic programme, the third forwards to the one who walks
    its backpointers. The programme carries four costs across Arrow batches, the walker one state, the edits
    so far and a running digest; backpointers take one byte a row and travel with it, so a conversation of
    any length is spilled by Spark and a lost executor's work is done again. A conversation is walked by one task.

    Null ids are one conversation, null turns come first and count in no gap. Rows with equal turns are ordered by role and
    text; equal rows after the first are duplicates. Rows that are ``gone`` only tell that their conversation exists: with
    no others its numbers are 0, its audit empty and its digest that of the empty text. A role without initial, or with
    any but s, u or a, cannot be kept. An empty table gives no rows; other columns are ignored.
    """
    session(rows.sparkSession)
    turn = ["conv_id", "turn", "role", "text", "copy"]
    own = rows.select("conv_id", "turn", "role", "text", "gone").repartition("conv_id")
    copy = F.expr("row_number() OVER (PARTITION BY conv_id, role, text, gone ORDER BY turn)")
    marked = own.withColumn("copy", copy).withColumn("fault", _fault(F.col("text"), F.col("copy")))
    last_first = marked.sortWithinPartitions("conv_id", *[F.desc_nulls_last(c) for c in turn[1:]])
    kinds = {f.name: f.dataType.simpleString() for f in last_first.schema}
    passed = ", ".join(f"{c} {kinds[c]}" for c in ("conv_id", "turn", "role", "text", "copy", "fault", "gone"))
    pointed = last_first.mapInArrow(_backwards, f"{passed}, moves short")
    conv_type = pa.int64() if kinds["conv_id"] == "bigint" else pa.int32() if kinds["conv_id"] == "int" else pa.string()
    forward = pointed.sortWithinPartitions(*turn)
    return forward.mapInArrow(_forwards(conv_type), SCHEMA.format(conv=kinds["conv_id"]))
