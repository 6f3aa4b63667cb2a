"""Repair of the structure of conversations by Wagner-Fischer alignment to the alternating grammar.

A conversation should read ``(s?(ua)+)?`` by the initials of its roles. Each turn may be kept (0), given the role
user or assistant (3) or deleted (4), and turns without text may be inserted (3); blank and repeated turns must be deleted, and a
truncated one that stays costs 3 more. The targets are the grammar strings of each feasible length. All of even
length are endings of one alternating string, and those of odd length are such an ending after a kept ``s``, so one table of the
costs of aligning the turns from i on to the last r roles holds every length: row 0 has the even ones, and the rows after
each ``s`` the odd ones.

Ukkonen's band: a repair of cost t inserts t / 3 turns and deletes t / 4 at most, so r stays that near to the
number of turns left. A narrow band gives a first repair, the incumbent; the band of the incumbent's cost then holds all
cheapest repairs. The table is filled row by row with array operations, and of long conversations only every ``STEP``-th
row is kept and the rest filled again on the way back. The audits of all cheapest lengths are traced together, letter by letter, and
those that fall behind in ASCII order are left.

Each turn crosses the shuffle twice in one exchange: without its text, to find the edits, and behind these the
turns with texts in the same order, to which the edits apply as they stream by. So a task holds some forty bytes a turn of
the conversation in hand, whatever its texts, and the turns of a long conversation are sorted with spilling.

Defined cases: a null role or text is one space; a null conv_id is a conversation of its own; turns without number come
first, equal numbers go by role and then by a digest of the text; a role of other initial than u or a is never kept in the grammar but for
a leading s; rows that are not alive (a column named by the caller) only name their conversation, so one without turns has zeros, an empty audit and an empty text;
an empty table gives no rows. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
ROLES = ("user", "assistant")
LEGAL = frozenset(("su", "ua", "au"))
STEP = 256
MOST_CELLS = 1 << 24
KEPT_SHAPES = 1 << 14
LONGEST_SHAPE = 32

# What a turn is to the alignment.
FINE, CUT, GONE = 0, 1, 2
FAR = 1 << 40

# The white space of a blank turn, and the ends of a sentence.
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
STOPS = (".", "!", "?")

AUDIT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)
REPAIRED = "conv_id long, position long, role string, text string, edit string"


class Table:
    """Costs of aligning the turns from i on to the last r roles of the grammar, for r near the number of turns left."""

    def __init__(self, initials: str, states: bytes, most: int):
        self.initials, self.states, self.n = initials, states, len(states)
        self.below, self.width = most // DELETE, most // DELETE + most // INSERT + 1
        self.cells = np.arange(self.width)
        self.every = 1 if self.n * self.width <= MOST_CELLS else STEP
        row = np.where(self.cells < self.below, FAR, INSERT * (self.cells - self.below))
        self.kept: dict[int, np.ndarray] = {self.n: row}
        self.block: dict[int, np.ndarray] = {}
        # Where a whole repair may begin: (turns before the grammar string, kept s before it, lengths, costs).
        self.begins = []
        for i in range(self.n - 1, -1, -1):
            if initials[i] == "s" and states[i] != GONE:
                before = DELETE * i + (TRUNCATED if states[i] == CUT else 0)
                self._begin(i, 1, i + 1, row, 2, before)
            row = self._above(i, row)
            if i % self.every == 0:
                self.kept[i] = row
        self._begin(0, 0, 0, row, 0, 0)
        self.cost = min(int(costs.min()) for *_, costs in self.begins if len(costs))

    def _begin(self, turn: int, lead: int, i: int, row: np.ndarray, least: int, before: int) -> None:
        lengths = self.cells + (self.n - i - self.below)
        chosen = (lengths >= least) & (lengths & 1 == 0)
        self.begins.append((turn, lead, lengths[chosen], row[chosen] + before))

    def place(self, i: int, turn: str) -> int:
        """Cost of turn i in the place of a role."""
        return (0 if self.initials[i] == turn else REROLE) + (TRUNCATED if self.states[i] == CUT else 0)

    def _above(self, i: int, after: np.ndarray) -> np.ndarray:
        """Row i from row i + 1."""
        lowest = self.n - i - self.below  # the r of the first cell
        row = np.append(after[1:], FAR) + DELETE
        if self.states[i] != GONE:
            # The next of r roles is a user if r is even.
            taken = after + np.where((self.cells + lowest) & 1, self.place(i, "a"), self.place(i, "u"))
            if lowest <= 0:
                taken[: 1 - lowest] = FAR
            row = np.minimum(row, taken)
        if lowest < 0:
            row[:-lowest] = FAR
        return np.minimum.accumulate(row - INSERT * self.cells) + INSERT * self.cells

    def row(self, i: int) -> np.ndarray:
        """Row i, filled again from the kept row below where it was not kept."""
        if i in self.kept:
            return self.kept[i]
        if i not in self.block:
            low = i - i % self.every
            top = min(self.n, low + self.every)
            self.block, row = {}, self.kept[top]
            for k in range(top - 1, low, -1):
                row = self.block[k] = self._above(k, row)
        return self.block[i]

    def costs(self, i: int, lengths: np.ndarray) -> np.ndarray:
        """The cells of row i at given numbers of roles; far outside of the band."""
        cell = lengths - (self.n - i - self.below)
        inside = (cell >= 0) & (cell < self.width) & (lengths >= 0)
        return np.where(inside, self.row(i)[np.clip(cell, 0, self.width - 1)], FAR)

    def audit(self) -> str:
        """The ASCII-least audit of those of all cheapest repairs, of every length."""
        leads = sorted(((turn, lengths[costs == self.cost]) for turn, lead, lengths, costs in self.begins if lead), key=lambda x: x[0])
        leads = [x for x in leads if len(x[1])]
        *_, lengths, costs = self.begins[-1]
        live = lengths[costs == self.cost]  # roles to go, of each repair with the letters so far
        letters: list[str] = []
        i, left = 0, self.cost
        while not (i == self.n and 0 in live):
            if leads:
                here = leads[0][1] if leads[0][0] == i else live[:0]
                later = leads[1:] if len(here) else leads
            else:
                here, later = live[:0], []
            more = TRUNCATED if i < self.n and self.states[i] == CUT else 0
            options = {}
            if i < self.n:
                options["D"] = (live[self.costs(i + 1, live) + DELETE == left], later, DELETE, 1)
            options["I"] = (live[(live > 0) & (self.costs(i, live - 1) + INSERT == left)] - 1, [], INSERT, 0)
            if i < self.n and self.states[i] != GONE:
                taken = live[(live > 0)]
                for letter, more_cost in (("K", more), ("R", more + REROLE)):
                    role = np.where(taken & 1, self.place(i, "a"), self.place(i, "u"))
                    fits = taken[(role == more_cost) & (self.costs(i + 1, taken - 1) + more_cost == left)] - 1
                    options[letter] = (np.union1d(fits, here) if letter == "K" else fits, [], more_cost, 1)
            for letter in "DIKR":
                if letter in options and (len(options[letter][0]) or options[letter][1]):
                    live, leads, cost, step = options[letter]
                    letters.append(letter)
                    left -= cost
                    i += step
                    break
        return "".join(letters)


def align(initials: str, states: bytes) -> tuple[int, str]:
    """The least cost of a repair and its audit; ``states`` has a byte per turn (``FINE``, ``CUT`` or ``GONE``)."""
    most = DELETE * states.count(GONE) + TRUNCATED * states.count(CUT) + 2 * DELETE + REROLE
    table = Table(initials, states, most)
    if table.cost > most:
        table = Table(initials, states, table.cost)
    return table.cost, table.audit()


def edits(audit: str) -> Iterator[tuple[str, str | None]]:
    """Each letter of an audit with the role of its place: None for a deleted turn, ``s`` for a kept leading one."""
    size = sum(letter != "D" for letter in audit)
    at = -(size & 1)
    for letter in audit:
        if letter == "D":
            yield letter, None
        else:
            yield letter, "s" if at < 0 else ROLES[at & 1]
            at += 1


class Conversation:
    """What is known of the conversation in hand."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.initials: list[str] = []
        self.states = bytearray()
        self.seen: set[bytes] = set()
        self.turns: list[int] = []  # lowest, highest
        self.distinct = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.aligned: tuple[int, str] | None = None

    def add(self, turn: int | None, initial: str, digest: bytes, blank: bool, cut: bool) -> None:
        repeated = digest in self.seen
        self.seen.add(digest)
        self.blank += blank
        self.duplicate += repeated and not blank
        self.truncated += cut and not blank and not repeated
        self.states.append(GONE if blank or repeated else CUT if cut else FINE)
        if self.initials:
            self.illegal += self.initials[-1] + initial not in LEGAL
        self.initials.append(initial)
        if turn is not None:
            if not self.turns:
                self.turns, self.distinct = [turn, turn], 1
            elif turn != self.turns[1]:
                self.turns[1], self.distinct = turn, self.distinct + 1

    def close(self, known: dict) -> None:
        """Find the edits, with the shapes of short conversations known."""
        if self.aligned is None:
            self.seen.clear()
            # One character a turn, so that an empty or longer initial can not shift the others.
            shape = "".join(i or "?" for i in self.initials), bytes(self.states)
            found = known.get(shape)
            if found is None:
                found = align(*shape)
                if len(shape[1]) <= LONGEST_SHAPE and len(known) < KEPT_SHAPES:
                    known[shape] = found
            self.aligned = found
            self.todo = edits(found[1])

    def apply(self, role: str | None, text: str | None) -> Iterator[tuple[str, str, str]]:
        """What comes out up to and with the next turn, or after the last (role None): (letter, role, text)."""
        for letter, place in self.todo:
            if letter == "I":
                yield letter, place, ""
                continue
            if letter != "D":
                yield letter, role if letter == "K" else place, text
            return

    def gaps(self) -> int:
        return self.turns[1] - self.turns[0] + 1 - self.distinct if self.turns else 0


def _streamed(batches: Iterator[pa.RecordBatch], names: list[str], kinds: list[pa.DataType], audits: bool) -> Iterator[pa.RecordBatch]:
    known: dict = {}
    now: Conversation | None = None
    sha, position, out = hashlib.sha256(), 0, []

    def emit(pieces) -> None:
        nonlocal position
        for letter, role, text in pieces:
            if audits:
                sha.update(f"{chr(10) if position else ''}{role}:{text}".encode())
            else:
                out.append((now.conv_id, position, role, text, letter))
            position += 1

    def end() -> None:
        now.close(known)
        emit(now.apply(None, None))
        if audits:
            counts = (now.gaps(), now.blank, now.duplicate, now.truncated, now.illegal)
            out.append((now.conv_id, *counts, *now.aligned, sha.hexdigest()))

    def taken() -> pa.RecordBatch:
        columns = zip(*out, strict=True) if out else [()] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    for batch in batches:
        for conv_id, phase, turn, role, digest, text, blank, cut in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now is None or conv_id != now.conv_id:
                if now is not None:
                    end()
                now, sha, position = Conversation(conv_id), hashlib.sha256(), 0
            if phase == 1:
                now.add(turn, role[:1], digest, blank, cut)
            elif phase == 2:
                now.close(known)
                emit(now.apply(role, text))
        yield taken()
        out = []
    if now is not None:
        end()
        yield taken()


def _stream(conversations: DataFrame, schema: str, audits: bool, alive: str | None) -> DataFrame:
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
        (F.col(alive) if alive else F.lit(True)).alias("alive"),
    )
    core = F.rtrim("text", F.lit(SPACES))
    marked = rows.select(
        "conv_id", "turn", "role", "text", "alive", (core == "").alias("blank"), (~F.right(core, F.lit(1)).isin(*STOPS)).alias("cut"),
        F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)).alias("digest"),
    )
    # The order of turns goes by columns of both phases; a row that is not alive only names its conversation (phase 0).
    twice = marked.select(
        "conv_id", F.explode(F.when(F.col("alive"), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(0)))).alias("phase"),
        "turn", "role", "digest", "text", "blank", "cut",
    ).withColumn("text", F.when(F.col("phase") == 2, F.col("text")))
    order = ["conv_id", "phase", "turn", "role", "digest"]
    dealt = twice.repartition("conv_id").sortWithinPartitions(*order)
    names = [part.split()[0] for part in schema.split(", ")]
    kinds = [pa.int64() if part.endswith("long") else pa.string() for part in schema.split(", ")]
    return dealt.mapInArrow(lambda batches: _streamed(batches, names, kinds, audits), schema)


def audit(conversations: DataFrame, alive: str | None = None) -> DataFrame:
    """A row per conversation: its faults, the cost and letters of its repair, and a digest of the repaired turns.

    ``alive`` names a boolean column; rows where it is false only name their conversation.
    """
    return _stream(conversations, AUDIT, True, alive)


def repair(conversations: DataFrame, alive: str | None = None) -> DataFrame:
    """The turns of the repaired conversations, numbered from 0, with the edit that each came by."""
    return _stream(conversations, REPAIRED, False, alive)


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` with planted faults by a checksum of conv_id and turn; dropped rows stay with ``alive`` false."""
    blank = F.lit(" ")
    named: list[Column] = [F.coalesce(F.col(c).cast("long").cast("string"), blank) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat_ws(":", *named).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", "".join(STOPS), "")).otherwise(F.col("text"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, ROLES[0]).otherwise(F.col("role")).alias("role"), text.alias("text"),
        (F.col("kind") != 0).alias("alive"), F.explode(copies).alias("copy"),
    ).drop("copy")
