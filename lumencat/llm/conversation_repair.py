"""Cheapest repair of the order of speakers in a conversation.

Edits of a row: Keep (0), Rerole to user or assistant (1), Delete (2, required
for blank and duplicate rows); an empty-text user or assistant row may be
Inserted anywhere (5); a truncated row that stays adds 5. The repaired roles'
initials must read (s?(ua)+)?; of the cheapest repairs the one whose edit
letters are least in ASCII wins. The letters decide the repair: a position's
role follows from the pattern.

All is decided by the minimum of ordinary integers. A path through the graph
(rows taken) x (last role) has one number: its cost in the high digits, below
it its letters as fixed-width digits by position, padded with zeros at the end,
so a prefix is less than what continues it. Two paths to one node have taken
the same rows, so neither is a prefix of the other and what follows cannot
change their order. A conversation of any length keeps numbers of bounded
width: after BLOCK_ROWS rows the letters so far of the four nodes are put
aside, and the digit in front takes their rank.

Rows come sorted, one conversation after the other, and are dropped as they are
taken: each node carries the digest of its repaired text so far, so a task's
memory is one Arrow batch and the letters, also where one conversation holds a
third of all rows. A SHA-256 is sequential by nature, so one conversation stays
one task; duplicates are found before by a window that spills.

Defined results: null role and text are one space; a null turn sorts first and
counts for no gap; rows of one turn follow by role and text; a null conv_id is
a conversation of its own; a conversation without a row left has zeros and an
empty repair; an empty role has no initial and is never kept; gaps beyond 64
bits are cut to them; empty table: no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import release_memory, small_batches

#: ASCII white space, as the contract's words are split at.
SPACE = " \t\n\v\f\r"
#: Faults of a row, in the order in which the first one counts.
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
KEEP, REROLE, DELETE, INSERT, CUT_SHORT = 0, 1, 2, 5, 5
#: Digits of the letters in ASCII order; 0 is the padding.
DIGIT = {"D": 1, "I": 2, "K": 3, "R": 4}
LETTER = "\0DIKR"
#: Rows after which letters are put aside: a row adds at most three letters.
BLOCK_ROWS = 64
DIGIT_BITS = 3
SLOTS = 1 + 3 * (BLOCK_ROWS + 1)
BITS = DIGIT_BITS * SLOTS
PLAN = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
_PLAN_SCHEMA = pa.schema([(name, pa.int64() if kind == "bigint" else pa.string()) for name, kind in (c.split() for c in PLAN.split(", "))])
LEGAL = {b"su", b"ua", b"au"}


def damaged(conversations: DataFrame, key: Column | None = None) -> DataFrame:
    """conv_id, turn, role, text, copy, present: the rows with the damage that crc32(key) % 20 deals.

    0 drops the row (present is false), 1 empties its text, 2 takes its
    sentence ends, 3 repeats it, 4 makes it a user's.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    deal = F.crc32((F.concat(text("conv_id"), F.lit(":"), text("turn")) if key is None else key).cast("binary")) % 20
    rows = conversations.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), text("role").alias("role"), text("text").alias("text"), deal.alias("deal"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("deal") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("deal") <= 1, "").when(F.col("deal") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("deal") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
        (F.col("deal") != 0).alias("present"),
    )


def ordered(rows: DataFrame) -> DataFrame:
    """Rows with their fault (0: none): a conversation's rows in one partition, by turn.

    rows has conv_id, turn, role, text and, optionally, copy and present; what
    is not present only names its conversation. One exchange serves the window
    and the order.
    """
    null = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    copy = F.col("copy") if "copy" in rows.columns else F.lit(0)
    present = F.col("present") if "present" in rows.columns else F.lit(True)
    rows = rows.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), null("role"), null("text"), copy.alias("copy"), present.alias("present")).repartition("conv_id")
    seen = F.row_number().over(Window.partitionBy("conv_id", "role", "text", "present").orderBy(F.asc_nulls_first("turn"), "copy"))
    ending = F.rtrim("text", F.lit(SPACE))
    fault = F.when(ending == "", BLANK).when(F.col("seen") > 1, DUPLICATE).when(~F.right(ending, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(0)
    rows = rows.withColumn("seen", seen).withColumn("fault", fault).drop("seen")
    return rows.sortWithinPartitions("conv_id", "present", F.asc_nulls_first("turn"), "role", "text", "copy")


class _Path:
    """The best way to a node: its number, the next free digit, the digest of its text, and letters put aside."""

    __slots__ = ("number", "slot", "digest", "past")

    def __init__(self, number: int, slot: int, digest: hashlib._Hash, past: tuple | None) -> None:
        self.number, self.slot, self.digest, self.past = number, slot, digest, past

    def plus(self, cost: int, letter: str) -> int:
        """The number of the path that goes on by this edit."""
        return self.number + (cost << BITS) + (DIGIT[letter] << DIGIT_BITS * (SLOTS - 1 - self.slot))

    def letters(self) -> str:
        """The letters since some were put aside last."""
        digits = self.number >> DIGIT_BITS * (SLOTS - self.slot)
        return "".join(LETTER[digits >> DIGIT_BITS * i & 7] for i in range(self.slot - 2, -1, -1))


#: Edges: (number of the longer path, path, row that it writes or nothing).
_Edge = tuple[int, _Path, bytes | None]


def _taken(edges: list[_Edge]) -> _Path | None:
    if not edges:
        return None
    number, path, written = min(edges, key=lambda e: e[0])
    digest = path.digest
    if written is not None:
        digest = digest.copy()
        digest.update(written)
    return _Path(number, path.slot + 1, digest, path.past)


class Repair:
    """Takes a conversation's rows in order; the nodes are the last role written: none, s, u, a."""

    def __init__(self) -> None:
        self.none: _Path | None = _Path(0, 1, hashlib.sha256(), None)
        self.s: _Path | None = None
        self.u: _Path | None = None
        self.a: _Path | None = None
        self.rows = self.block = self.illegal = self.distinct = 0
        self.faults = [0, 0, 0, 0]
        self.last = b""
        self.first_turn: int | None = None
        self.last_turn: int | None = None

    def _inserted(self) -> None:
        """Paths that go on by inserted rows; a second one never returns to a node more cheaply."""
        edges = [(p.plus(INSERT, "I"), p, b"user:" if p is self.none else b"\nuser:") for p in (self.none, self.s, self.a) if p]
        best = min(edges, key=lambda e: e[0])
        if self.u is None or best[0] < self.u.number:
            self.u = _taken([best])
        number = self.u.plus(INSERT, "I")
        if self.a is None or number < self.a.number:
            self.a = _taken([(number, self.u, b"\nassistant:")])

    def take(self, turn: int | None, role: bytes, text: bytes, fault: int) -> None:
        """The next row."""
        if turn is not None:
            self.distinct += turn != self.last_turn
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        initial = role.decode()[:1].encode()
        self.illegal += self.rows > 0 and self.last + initial not in LEGAL
        self.last = initial
        self.rows += 1
        self.faults[fault] += 1
        if self.block == BLOCK_ROWS:
            self._put_aside()
        self.block += 1
        self._inserted()

        stay = CUT_SHORT if fault == TRUNCATED else 0
        free = fault not in (BLANK, DUPLICATE)
        deleted = {n: [(p.plus(DELETE, "D"), p, None)] if (p := getattr(self, n)) else [] for n in ("none", "s", "u", "a")}
        body = b":" + text
        if free:
            if initial == b"s" and self.none:
                deleted["s"].append((self.none.plus(KEEP + stay, "K"), self.none, role + body))
            for p in (self.none, self.s, self.a):
                if p:
                    line = b"" if p is self.none else b"\n"
                    deleted["u"].append((p.plus(REROLE + stay, "R"), p, line + b"user" + body))
                    if initial == b"u":
                        deleted["u"].append((p.plus(KEEP + stay, "K"), p, line + role + body))
            deleted["a"].append((self.u.plus(REROLE + stay, "R"), self.u, b"\nassistant" + body))
            if initial == b"a":
                deleted["a"].append((self.u.plus(KEEP + stay, "K"), self.u, b"\n" + role + body))
        self.none, self.s, self.u, self.a = (_taken(deleted[n]) for n in ("none", "s", "u", "a"))

    def _put_aside(self) -> None:
        """Start the digits anew: the letters so far are only their rank among the nodes."""
        paths = sorted((p for p in (self.none, self.s, self.u, self.a) if p), key=lambda p: p.number & (1 << BITS) - 1)
        for rank, p in enumerate(paths):
            p.past = p.past, p.letters()
            p.number = (p.number >> BITS << BITS) + (rank << DIGIT_BITS * (SLOTS - 1))
            p.slot = 1
        self.block = 0

    def plan(self) -> tuple:
        """gaps, blank, duplicate, truncated, illegal, cost, audit, digest."""
        if not self.rows:
            return 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest()
        self._inserted()
        best = min((p for p in (self.none, self.a) if p), key=lambda p: p.number)
        pieces, past = [best.letters()], best.past
        while past:
            past, piece = past
            pieces.append(piece)
        gaps = 0 if self.first_turn is None else min(self.last_turn - self.first_turn + 1 - self.distinct, (1 << 63) - 1)
        return gaps, *self.faults[1:], self.illegal, best.number >> BITS, "".join(reversed(pieces)), best.digest.hexdigest()


def repair_plans(rows: DataFrame) -> DataFrame:
    """The gaps, faults, cost, edit letters (audit) and digest of the repair of every conversation (columns: PLAN)."""
    small_batches(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conversation, repair, done = None, None, []

        def packed() -> pa.RecordBatch:
            columns = dict(zip(_PLAN_SCHEMA.names, zip(*done, strict=True), strict=True))
            done.clear()
            return pa.RecordBatch.from_pydict(columns, _PLAN_SCHEMA)

        for batch in batches:
            for conv, turn, role, text, present, fault in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if repair is None or conv != conversation:
                    if repair is not None:
                        done.append((conversation, *repair.plan()))
                    conversation, repair = conv, Repair()
                if present:
                    repair.take(turn, role, text, fault)
            if done:
                yield packed()
        if repair is not None:
            done.append((conversation, *repair.plan()))
            yield packed()
        release_memory()

    columns = ["conv_id", "turn", F.col("role").cast("binary").alias("role"), F.col("text").cast("binary").alias("text"), "present", "fault"]
    return ordered(rows).select(*columns).mapInArrow(run, PLAN)



def repaired_turns(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """conv_id, position (from 0), role, text: the repaired conversations, from their rows and plans."""
    present = ordered(rows).where("present")
    number = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text", "copy"))
    own = present.select("conv_id", number.alias("row"), "role", "text")
    edits = plans.where("audit != ''").select("conv_id", F.posexplode(F.split("audit", "")).alias("at", "edit"))
    in_order = Window.partitionBy("conv_id").orderBy("at")
    edits = edits.select(
        F.col("conv_id").alias("of"),
        F.when(F.col("edit") != "I", F.sum((F.col("edit") != "I").cast("int")).over(in_order)).alias("of_row"),
        (F.sum((F.col("edit") != "D").cast("int")).over(in_order) - 1).alias("position"),
        "edit",
    ).where("edit != 'D'")
    found = edits.join(own, F.col("of").eqNullSafe(F.col("conv_id")) & (F.col("of_row") == F.col("row")), "left")
    first = F.first(F.when((F.col("edit") == "K") & F.col("role").startswith("s"), 1).otherwise(0)).over(Window.partitionBy("of").orderBy("position").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    due = F.when((F.col("position") - first) % 2 == 0, "user").otherwise("assistant")
    return found.select(F.col("of").alias("conv_id"), "position", F.when(F.col("edit") == "K", F.col("role")).otherwise(due).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
