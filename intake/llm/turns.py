"""Repair of conversations: the cheapest edits that make their roles alternate again.

The roles of a repaired conversation read ``(s?(ua)+)?`` by their initials: perhaps a system
message, then user and assistant in turns. Edits: Keep costs 0, Rerole to user or assistant 2,
Delete 3 (a must for blank and repeated rows), Insert an empty user or assistant message
2; a truncated row that stays adds 1. Of equally cheap edits the ASCII-least letters count.

Rows are dealt by conversation and sorted by turn, and two passes stream through them, whatever a
conversation's length. The first goes from the last row to the first and carries the costs to
the end for each of four states; what it found best for each row and state, two bytes a row,
leaves as blocks to the shared folder. The second goes forward with rows and blocks merged by one
sort, carries the state, and reads off the edits. Both hold one Arrow batch and a block or two.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from intake.llm.common import settled

# What separates words, and what ends a whole message.
_BLANKS = " \t\n\x0b\x0c\r"
_ENDS = (".", "!", "?")

EDIT_COSTS = {"K": 0, "R": 2, "D": 3, "I": 2}
TRUNCATED_COST = 1

# Faults of a row, the first that applies.
_FINE, _BLANK, _DUPLICATE, _TRUNCATED = range(4)
# States: nothing yet, after a system, a user, an assistant message.
_NONE, _S, _U, _A = range(4)
_INITIALS = {"s": _S, "u": _U, "a": _A}
_INSERTED = (_U, _U, _A, _U)
_NAMES = {_U: "user", _A: "assistant"}
_KEPT = {(_NONE, _S): _S, (_NONE, _U): _U, (_S, _U): _U, (_A, _U): _U, (_U, _A): _A}
_LEGAL = {(_S, _U), (_U, _A), (_A, _U)}
_EDITS = "DKR"
# Messages to insert behind the last row, by state.
_TAIL = (0, 2, 1, 0)

#: Rows whose choices make one block.
BLOCK = 1 << 16


def _before(costs: tuple[int, ...], initial: int, fault: int) -> tuple[tuple[int, ...], int, int]:
    """Costs to the end ahead of a row, from those behind it: above their least, the least, the choices.

    A choice, four bits a state, is a number of messages to insert and then the row's edit. More than
    two inserted messages in a row lead back to a state that was there before.
    """
    found, choices = [], 0
    extra = TRUNCATED_COST if fault == _TRUNCATED else 0
    for state in range(4):
        options, at = [], state
        for k in range(3):
            spent = EDIT_COSTS["I"] * k
            options.append((spent + EDIT_COSTS["D"] + costs[at], "I" * k + "D", k))
            if fault not in (_BLANK, _DUPLICATE):
                if (at, initial) in _KEPT:
                    options.append((spent + EDIT_COSTS["K"] + extra + costs[_KEPT[at, initial]], "I" * k + "K", k))
                options.append((spent + EDIT_COSTS["R"] + extra + costs[_INSERTED[at]], "I" * k + "R", k))
            at = _INSERTED[at]
        cost, letters, k = min(options)
        found.append(cost)
        choices |= (3 * _EDITS.index(letters[-1]) + k) << 4 * state
    least = min(found)
    return tuple(c - least for c in found), least, choices


class _Backward:
    """The costs of one conversation, fed from its last row to its first."""

    def __init__(self, conv: str | None, known: dict[tuple, tuple]) -> None:
        self.conv = conv
        self.known = known  # steps by their arguments: there are few different ones
        self.costs: tuple[int, ...] = tuple(EDIT_COSTS["I"] * n for n in _TAIL)
        self.least = 0
        self.choices: list[int] = []
        self.rows = 0
        self.faults = [0] * 4
        self.illegal = 0
        self.next = -1
        self.high: int | None = None
        self.low: int | None = None
        self.turns = 0
        self.key: tuple = ()

    def add(self, turn: str | None, role: str, digest: bytes, initial: int, fault: int) -> None:
        step = self.costs, initial, fault
        if step not in self.known:
            self.known[step] = _before(*step)
        self.costs, least, choices = self.known[step]
        self.least += least
        self.choices.append(choices)
        self.faults[fault] += 1
        if self.rows and (initial, self.next) not in _LEGAL:
            self.illegal += 1
        self.next = initial
        if turn is not None:
            number = int(turn)
            self.high = number if self.high is None else self.high
            self.turns += number != self.low
            self.low = number
        self.rows += 1
        self.key = (turn, role, digest)

    def block(self, last: bool) -> tuple:
        """The choices since the block before, the conversation's first row first."""
        data = np.array(self.choices[::-1], "<u2").tobytes()
        self.choices = []
        gaps = self.high - self.low + 1 - self.turns if last and self.high is not None else 0
        return (
            self.conv, *self.key, self.rows, data, last, gaps, self.faults[_BLANK], self.faults[_DUPLICATE],
            self.faults[_TRUNCATED], self.illegal, self.costs[_NONE] + self.least,
        )


_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_BLOCK_COLUMNS = ["conv", "turn", "role", "digest", "left", "choices", "opens", *_COUNTS]
_BLOCK_SCHEMA = (
    "conv string, turn string, role string, digest binary, left long, choices binary, opens boolean, "
    + ", ".join(f"{c} long" for c in _COUNTS)
)


def _backward(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    state: _Backward | None = None
    known: dict[tuple, tuple] = {}
    for part in parts:
        blocks = []
        for conv, turn, role, digest, initial, fault in part.itertuples(index=False, name=None):
            if state is None or state.conv != conv:
                if state is not None:
                    blocks.append(state.block(True))
                state = _Backward(conv, known)
            elif len(state.choices) == BLOCK:
                blocks.append(state.block(False))
            state.add(turn, role, digest, initial, fault)
        if blocks:
            yield pd.DataFrame(blocks, columns=_BLOCK_COLUMNS)
    if state is not None:
        yield pd.DataFrame([state.block(True)], columns=_BLOCK_COLUMNS)


class _Forward:
    """The edits of one conversation, fed from its first row to its last."""

    def __init__(self, conv: str | None, counts: tuple) -> None:
        self.conv, self.counts = conv, counts
        self.blocks: deque[memoryview] = deque()
        self.at = 0
        self.state = _NONE
        self.audit = bytearray()
        self.digest = hashlib.sha256()
        self.place = 0

    def _out(self, edit: str, role: str, text: str) -> tuple:
        self.digest.update(f"{chr(10) if self.place else ''}{role}:{text}".encode())
        self.place += 1
        return self.conv, self.place - 1, role, text, edit

    def _insert(self, n: int) -> Iterator[tuple]:
        for _ in range(n):
            self.state = _INSERTED[self.state]
            self.audit += b"I"
            yield self._out("I", _NAMES[self.state], "")

    def add(self, role: str, text: str, initial: int) -> Iterator[tuple]:
        if self.at == len(self.blocks[0]):
            self.blocks.popleft()
            self.at = 0
        choice = self.blocks[0][self.at] >> 4 * self.state & 15
        self.at += 1
        yield from self._insert(choice % 3)
        edit = _EDITS[choice // 3]
        self.audit += edit.encode()
        if edit == "K":
            self.state = _KEPT[self.state, initial]
            yield self._out(edit, role, text)
        elif edit == "R":
            self.state = _INSERTED[self.state]
            yield self._out(edit, _NAMES[self.state], text)

    def end(self) -> Iterator[tuple]:
        yield from self._insert(_TAIL[self.state])

    def summary(self) -> tuple:
        return self.conv, *self.counts, self.audit.decode(), self.digest.hexdigest()


_MESSAGE_COLUMNS = ["conv", "place", "role", "text", "edit"]
_MESSAGE_SCHEMA = "conv string, place long, role string, text string, edit string"
_SUMMARY_COLUMNS = ["conv", *_COUNTS, "audit", "repaired_sha256"]
_SUMMARY_SCHEMA = "conv string, " + ", ".join(f"{c} long" for c in _COUNTS) + ", audit string, repaired_sha256 string"


def _forward(messages: bool):
    columns = _MESSAGE_COLUMNS if messages else _SUMMARY_COLUMNS

    def walk(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state: _Forward | None = None

        def closed(held: _Forward) -> list[tuple]:
            rest = list(held.end())
            return rest if messages else [held.summary()]

        for part in parts:
            out: list[tuple] = []
            for conv, role, text, initial, choices, *counts in part.itertuples(index=False, name=None):
                if state is None or state.conv != conv:
                    if state is not None:
                        out += closed(state)
                    # A conversation's first block comes ahead of its rows.
                    state = _Forward(conv, tuple(int(c) for c in counts))
                if choices is not None:
                    state.blocks.append(memoryview(np.frombuffer(choices, "<u2")))
                else:
                    made = list(state.add(role, text, initial))
                    out += made if messages else ()
            if out:
                yield pd.DataFrame(out, columns=columns)
        if state is not None and (out := closed(state)):
            yield pd.DataFrame(out, columns=columns)

    return walk


def _last_sign(text: Column) -> Column:
    """The last character that is no blank; empty if there is none."""
    return F.right(F.rtrim(text, F.lit(_BLANKS)), F.lit(1))


def _coded(rows: DataFrame) -> DataFrame:
    """The rows with all that the passes need, conversation and turn as text (nulls stay null)."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit(" ")), F.coalesce(F.col("text").cast("string"), F.lit(" "))
    initial = F.coalesce(*[F.when(F.left(F.col("role"), F.lit(1)) == c, F.lit(n)) for c, n in _INITIALS.items()], F.lit(0))
    last = _last_sign(F.col("text"))
    fault = F.when(last == "", F.lit(_BLANK)).when(~last.isin(*_ENDS), F.lit(_TRUNCATED)).otherwise(F.lit(_FINE))
    digest = F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256))
    return rows.select(
        F.col("conv_id").cast("long").cast("string").alias("conv"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text")
    ).select("conv", "turn", "role", "text", digest.alias("digest"), initial.alias("initial"), fault.alias("fault"))


def _walked(rows: DataFrame, messages: bool) -> DataFrame:
    coded = _coded(rows)
    same = Window.partitionBy("conv", "digest").orderBy(F.col("turn").asc_nulls_first())
    repeated = (F.col("fault") != _BLANK) & (F.row_number().over(same) > 1)
    judged = coded.drop("text").repartition("conv").withColumn("fault", F.when(repeated, F.lit(_DUPLICATE)).otherwise(F.col("fault")))
    # Repeated rows of a turn: the first one, which may stay, stands first.
    judged = judged.sortWithinPartitions(
        "conv", F.col("turn").desc_nulls_last(), F.desc("role"), F.desc("digest"), F.desc(F.col("fault") == _DUPLICATE)
    ).select("conv", F.col("turn").cast("string").alias("turn"), "role", "digest", "initial", "fault")
    blocks = settled(judged.mapInPandas(_backward, _BLOCK_SCHEMA), "choices")
    nothing = [F.lit(None).cast("binary").alias("choices"), *[F.lit(0).cast("long").alias(c) for c in _COUNTS]]
    merged = coded.select(
        "conv", "turn", "role", "digest", F.lit(1).alias("kind"), F.lit(0).cast("long").alias("left"), "text", "initial", *nothing
    ).unionByName(
        blocks.select(
            "conv", F.col("turn").cast("long").alias("turn"), "role", "digest", F.lit(0).alias("kind"), "left",
            F.lit(None).cast("string").alias("text"), F.lit(0).alias("initial"), "choices", *_COUNTS,
        )
    )
    merged = merged.repartition("conv").sortWithinPartitions(
        "conv", F.col("turn").asc_nulls_first(), "role", "digest", "kind", F.desc("left")
    ).select("conv", "role", "text", "initial", "choices", *_COUNTS)
    walked = merged.mapInPandas(_forward(messages), _MESSAGE_SCHEMA if messages else _SUMMARY_SCHEMA)
    return walked.withColumn("conv", F.col("conv").cast("long")).withColumnRenamed("conv", "conv_id")


def repaired(rows: DataFrame) -> DataFrame:
    """The repaired messages: conv_id, place (from 0), role, text, edit (K, R or I) of each.

    Reads conv_id, turn, role and text. Null roles and texts are one space; a null conv_id is a
    conversation of its own; null turns come first, rows of one turn in order of role and a
    digest of role and text. Roles whose initial is none of s, u, a are never kept as they are. Of rows
    with equal role and text the first by turn counts, wherever the others are. No rows, no messages.
    """
    return _walked(rows, messages=True)


def audited(rows: DataFrame) -> DataFrame:
    """What the repair of each conversation found and did; rows as for ``repaired``.

    conv_id; gaps (numbers missing between its turns); blank, duplicate, truncated rows, by a
    row's first fault; illegal (neighbouring roles that may not be neighbours); the edits'
    cost; their letters in order, ``audit``; repaired_sha256 of the messages as lines ``role:text``.
    """
    return _walked(rows, messages=False)


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after seeded damage, by the CRC-32 of ``conv_id:turn`` modulo 20.

    0 drops a row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 makes its role user.
    Nulls read as one space, but a null conv_id or turn stays null.
    """
    number = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    case = F.crc32(F.concat_ws(":", *number).cast("binary")) % 20
    text = F.coalesce(F.col("text"), F.lit(" "))
    return (
        rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"), case.alias("case"))
        .where("case <> 0")
        .withColumn("copy", F.explode(F.when(F.col("case") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        .select(
            "conv_id",
            "turn",
            F.when(F.col("case") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
            F.when(F.col("case") == 1, F.lit("")).when(F.col("case") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        )
    )


def audited_among(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """``audited``, with a row for every conv_id of ``conversations`` (null included), also those without rows."""
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    found = audited(rows).withColumnRenamed("conv_id", "_conv")
    nothing = {**dict.fromkeys(_COUNTS, 0), "audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    filled = [F.coalesce(F.col(c), F.lit(v).cast("long" if v == 0 else "string")).alias(c) for c, v in nothing.items()]
    return ids.join(found, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").select("conv_id", *filled)
