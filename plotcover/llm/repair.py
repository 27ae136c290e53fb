"""Conversation structure repair by bidirectional Dijkstra (operator 12).

The rows of a conversation, in order of turn, are edited until the initials of
their roles read ``(s?(ua)+)?``: nothing, or user and assistant in turn, after
at most one system row.  Edits: Keep costs 0, Rerole (to user or assistant) 3,
Delete 4, Insert (an empty user or assistant text) 3.  Blank and duplicate rows
must go; a truncated row that stays costs 3 more.  Of the cheapest edits the one
whose audit (the initials of its edits, in order) comes first in ASCII is taken.

The edit lattice has a node for each number of rows read and each state of that
expression.  Two heaps work on it, one from the start and one from the end; once
their heads together cost more than the best meeting, every crossing of that
cost is known and the least concatenated audit wins.  An audit is never a prefix
of another of equal cost to the same node (the longer one would insert more), so
the least halves make the least whole.

Rows are range-partitioned by conversation and order, so a conversation of any
size is spread over tasks, and each task cuts what it reads into segments of at
most ``SEGMENT`` rows.  A conversation that is one segment is solved there.  For
a piece of a longer one, or one at a partition's border, the segment gives the
cheapest edits between any two states; segments are then folded ``FOLD`` at a
time.  Repaired turns join their texts by row number; digests stream over them.

Null roles and texts read as one space; a null conv_id is a conversation, null
turns come first.  Rows of one turn are in order of role and text (by their
first 64 characters, then by hash); equal rows stay rows.  An empty role can't
be kept.  Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plotcover.llm.common import bounded_batches, grouped, materialize

SEGMENT = 512     # rows of a conversation solved at once
FOLD = 64         # segments folded at once
SPACE = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3

# States: 0 nothing yet, 1 after the system row, 2 after a user row, 3 after an
# assistant row.  TURN is where a user or assistant row leads.
TURN = {0: 2, 1: 2, 2: 3, 3: 2}
ROLE_TO = {2: "user", 3: "assistant"}
ENDS = (0, 3)
INTO: dict[int, tuple[int, ...]] = {2: (0, 1, 3), 3: (2,)}
LEGAL = ("su", "ua", "au")


@dataclass(frozen=True)
class Row:
    """What the lattice needs of a row: the role's initial, whether it must be
    deleted, whether it is truncated."""
    initial: str
    doomed: bool
    truncated: bool

    def kept(self, state: int) -> tuple[int, str] | None:
        """Where keeping the row leads, and the letter.  Keeping a system row
        is J, which sorts as K does against the other edits."""
        if state == 0 and self.initial == "s":
            return 1, "J"
        to = TURN[state]
        return (to, "K") if self.initial == ROLE_TO[to][0] else None


class Lattice:
    """Nodes are (rows read, state); ``trailing`` allows inserts after the last row."""

    def __init__(self, rows: list[Row], trailing: bool):
        self.rows, self.trailing = rows, trailing

    def after(self, node: tuple[int, int]) -> Iterator[tuple[tuple[int, int], int, str]]:
        at, state = node
        if at < len(self.rows) or self.trailing:
            yield (at, TURN[state]), INSERT, "I"
        if at < len(self.rows):
            row = self.rows[at]
            yield (at + 1, state), DELETE, "D"
            if not row.doomed:
                more = TRUNCATED if row.truncated else 0
                yield (at + 1, TURN[state]), REROLE + more, "R"
                kept = row.kept(state)
                if kept:
                    yield (at + 1, kept[0]), KEEP + more, kept[1]

    def before(self, node: tuple[int, int]) -> Iterator[tuple[tuple[int, int], int, str]]:
        at, state = node
        if at < len(self.rows) or self.trailing:
            for was in INTO.get(state, ()):
                yield (at, was), INSERT, "I"
        if at:
            row = self.rows[at - 1]
            yield (at - 1, state), DELETE, "D"
            if not row.doomed:
                more = TRUNCATED if row.truncated else 0
                for was in (0, 1, 2, 3):
                    if TURN[was] == state:
                        yield (at - 1, was), REROLE + more, "R"
                    kept = row.kept(was)
                    if kept and kept[0] == state:
                        yield (at - 1, was), KEEP + more, kept[1]


class Front:
    """One of the two searches: labels (cost, audit) and settled nodes.  Edges
    of cost 0 read a row, so nodes of equal cost settle in order of rows read
    and a label is final when its node settles."""

    def __init__(self, starts: Iterable[tuple[int, int]], step: int, edges):
        self.step, self.edges = step, edges
        self.label = {node: (0, "") for node in starts}
        self.heap = [(0, step * node[0], node) for node in self.label]
        heapq.heapify(self.heap)
        self.settled: set[tuple[int, int]] = set()

    def head(self) -> int | None:
        while self.heap and self.heap[0][2] in self.settled:
            heapq.heappop(self.heap)
        return self.heap[0][0] if self.heap else None

    def settle(self) -> tuple[int, int]:
        cost, _, node = heapq.heappop(self.heap)
        self.settled.add(node)
        audit = self.label[node][1]
        for other, more, letter in self.edges(node):
            made = (cost + more, audit + letter if self.step > 0 else letter + audit)
            if other not in self.label or made < self.label[other]:
                if other not in self.label or made[0] < self.label[other][0]:
                    heapq.heappush(self.heap, (made[0], self.step * other[0], other))
                self.label[other] = made
        return node


def cheapest(rows: list[Row], start: int, ends: Iterable[int], trailing: bool) -> tuple[int, str] | None:
    """Cost and audit of the cheapest edits of all rows that lead from the
    state ``start`` to one of ``ends``; None where none do."""
    lattice = Lattice(rows, trailing)
    forward = Front([(0, start)], 1, lattice.after)
    reverse = Front([(len(rows), e) for e in ends], -1, lattice.before)
    best: int | None = None
    while True:
        one, two = forward.head(), reverse.head()
        if one is None or two is None or (best is not None and one + two > best):
            break
        side, other = (forward, reverse) if one <= two else (reverse, forward)
        node = side.settle()
        if node in other.label:
            meeting = side.label[node][0] + other.label[node][0]
            best = meeting if best is None else min(best, meeting)
    if best is None:
        return None
    found = []
    for node in forward.settled:
        cost, audit = forward.label[node]
        # every label is that of a real path; the least one crosses here too
        if node in reverse.label and cost + reverse.label[node][0] == best:
            found.append(audit + reverse.label[node][1])
        for to, more, letter in lattice.after(node):
            if to in reverse.label and cost + more + reverse.label[to][0] == best:
                found.append(audit + letter + reverse.label[to][1])
    return best, min(found)


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with the faults the query plants: by the crc32
    of ``conv_id:turn`` modulo 20, 0 drops the row, 1 empties its text, 2 takes
    its full stops, question and exclamation marks, 3 repeats it, 4 makes its
    role user.  Nulls read as one space."""
    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(text("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text("text"), ".!?", "")).otherwise(text("text")).alias("text"),
        F.explode(F.when(kind == 0, F.array().cast("array<int>")).when(kind == 3, F.array(F.lit(0), F.lit(1)))
                  .otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


SEGMENTS = ("no_id long, conv long, seg long, whole boolean, rows array<long>, first_turn long, last_turn long, "
            "low long, high long, turns long, blank long, duplicate long, truncated long, illegal long, "
            "first_role string, last_role string, paths array<struct<start:int,end:int,cost:long,audit:string>>")
ENTRY = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))


def _table(rows: list[dict]) -> pa.RecordBatch:
    longs = ("no_id", "conv", "seg", "first_turn", "last_turn", "low", "high", "turns", "blank", "duplicate",
             "truncated", "illegal")
    kinds = {"whole": pa.bool_(), "rows": pa.list_(pa.int64()), "first_role": pa.string(),
             "last_role": pa.string(), "paths": ENTRY} | {c: pa.int64() for c in longs}
    names = [c.split()[0] for c in SEGMENTS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds[n]) for n in names], names=names)


def _segment(key: tuple[int, int], seg: int, rows: list[tuple], whole: bool) -> dict:
    """One segment: its counts, and its cheapest edits (for a whole
    conversation those of the conversation, else between any two states)."""
    turns = [r[0] for r in rows]
    known = [t for t in turns if t is not None]
    roles = [r[2] for r in rows]
    faults = [r[3] for r in rows]
    lattice = [Row(role, fault in (1, 2), fault == 3) for role, fault in zip(roles, faults)]
    if whole:
        paths = [(0, ENDS[0], *cheapest(lattice, 0, ENDS, True))]
    else:
        paths = [(a, b, *found) for a in TURN for b in TURN for found in [cheapest(lattice, a, (b,), False)] if found]
    return {"no_id": key[0], "conv": key[1], "seg": seg, "whole": whole, "rows": [r[1] for r in rows],
            "first_turn": turns[0], "last_turn": turns[-1], "low": min(known, default=None),
            "high": max(known, default=None), "turns": len(set(known)),
            "blank": faults.count(1), "duplicate": faults.count(2), "truncated": faults.count(3),
            "illegal": sum(a + b not in LEGAL for a, b in zip(roles, roles[1:])),
            "first_role": roles[0], "last_role": roles[-1],
            "paths": [dict(zip(("start", "end", "cost", "audit"), p)) for p in paths]}


def _segments(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Segments of a partition's sorted rows.  Its first and last conversation
    may go on in another partition, so neither counts as whole."""
    seg = TaskContext.get().partitionId() << 40
    held: list[tuple] = []
    key, sure = None, False
    for batch in batches:
        out = []
        columns = [batch.column(c).to_pylist() for c in ("no_id", "conv", "turn", "row", "initial", "fault")]
        for no_id, conv, *row in zip(*columns):
            if (no_id, conv) != key:
                if held:
                    out.append(_segment(key, seg, held, sure))
                    seg += 1
                sure, held, key = key is not None, [], (no_id, conv)
            elif len(held) == size:
                out.append(_segment(key, seg, held, False))
                seg += 1
                sure, held = False, []
            held.append(tuple(row))
        if out:
            yield _table(out)
    if held:
        yield _table([_segment(key, seg, held, False)])


def _fold(table: pa.Table) -> pa.Table:
    """The segments of one group, in order, as one."""
    rows = table.sort_by("seg").to_pylist()
    done = rows[0]
    for r in rows[1:]:
        done["illegal"] += r["illegal"] + (done["last_role"] + r["first_role"] not in LEGAL)
        done["turns"] += r["turns"] - (done["last_turn"] is not None and done["last_turn"] == r["first_turn"])
        for c in ("blank", "duplicate", "truncated"):
            done[c] += r[c]
        done["low"] = min((x for x in (done["low"], r["low"]) if x is not None), default=None)
        done["high"] = max((x for x in (done["high"], r["high"]) if x is not None), default=None)
        best: dict[tuple[int, int], tuple[int, str]] = {}
        for p in done["paths"]:
            for n in r["paths"]:
                if p["end"] == n["start"]:
                    made = (p["cost"] + n["cost"], p["audit"] + n["audit"])
                    ends = (p["start"], n["end"])
                    best[ends] = min(best.get(ends, made), made)
        done["paths"] = [{"start": a, "end": b, "cost": c, "audit": s} for (a, b), (c, s) in best.items()]
        done["last_role"], done["last_turn"] = r["last_role"], r["last_turn"]
    done["rows"] = []
    return pa.Table.from_batches([_table([done])])


# What is inserted after the last row, to end well.
TRAILING = {0: "", 1: "II", 2: "I", 3: ""}


def _finish(paths: list[dict]) -> tuple[int, str]:
    return min((p["cost"] + INSERT * len(TRAILING[p["end"]]), p["audit"] + TRAILING[p["end"]])
               for p in paths if p["start"] == 0)


def _step(state: int, letter: str) -> int:
    return state if letter == "D" else 1 if letter == "J" else TURN[state]


@dataclass(frozen=True)
class Repair:
    """``summary``: one row a conversation, ``turns``: the repaired rows."""
    summary: DataFrame
    turns: DataFrame


KEYS = ["no_id", "conv"]


def _numbered(rows: DataFrame) -> DataFrame:
    return materialize(rows.select(
        F.col("conv_id").isNull().cast("long").alias("no_id"),
        F.coalesce(F.col("conv_id").cast("long"), F.lit(0).cast("long")).alias("conv"),
        F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"), F.monotonically_increasing_id().alias("row")), "numbered")


def _faults(numbered: DataFrame) -> DataFrame:
    """The rows without their texts: initial, fault (1 blank, 2 duplicate, 3
    truncated, 0 none) and what they are sorted by."""
    bare = F.rtrim(F.col("text"), F.lit(SPACE))
    last = F.right(bare, F.lit(1))
    narrow = numbered.select(
        *KEYS, "turn", "row", F.substring("role", 1, 1).alias("initial"),
        (F.length(bare) == 0).alias("blank"), (~last.isin(".", "!", "?")).alias("cut"),
        F.substring("role", 1, 64).alias("role_head"), F.substring("text", 1, 64).alias("text_head"),
        F.xxhash64("role", "text").alias("tie"),
        F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256))
        .alias("content"))
    first = (narrow.groupBy(*KEYS, "content").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct(F.col("turn").isNotNull(), "turn", "row")).alias("first"))
        .where("n > 1").select(*KEYS, "content", F.col("first.row").alias("first_row")))
    again = F.coalesce(F.col("first_row") != F.col("row"), F.lit(False))
    return narrow.join(first, [*KEYS, "content"], "left").select(
        *KEYS, "turn", "role_head", "text_head", "tie", "row", "initial",
        F.when(F.col("blank"), 1).when(again, 2).when(F.col("cut"), 3).otherwise(0).alias("fault"))


def _solve(numbered: DataFrame, segment: int, fold: int) -> tuple[DataFrame, DataFrame]:
    """Totals of each conversation, and each segment's rows with its part of
    the audit and the state it starts in."""
    order = [*KEYS, "turn", "role_head", "text_head", "tie", "row"]
    segments = materialize(_faults(numbered).repartitionByRange(*order).sortWithinPartitions(*order)
                           .mapInArrow(lambda batches: _segments(batches, segment), SEGMENTS), "segments")
    whole = segments.where("whole").select("*", F.col("paths")[0]["cost"].alias("cost"),
                                           F.col("paths")[0]["audit"].alias("audit"))
    pieces = segments.where("not whole")

    # ranks need only the segments' numbers; paths follow in bounded groups
    rank = (F.row_number().over(Window.partitionBy(*KEYS).orderBy("seg")) - 1).cast("long")
    folded = pieces.drop("rows").withColumn("rows", F.array().cast("array<long>"))
    last = pieces.groupBy(*KEYS).count().agg(F.max("count") - 1).first()[0]
    while last is not None:
        groups = folded.join(folded.select("seg", F.floor(rank / fold).alias("group")), "seg")
        folded = materialize(groups.select(*segments.columns, "group").groupBy(*KEYS, "group")
                             .applyInArrow(_fold, SEGMENTS), "folded")
        last = last // fold or None

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = [_finish(p) for p in batch.column("paths").to_pylist()]
            columns = [c for c in batch.schema.names if c != "paths"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array([c for c, _ in ends], pa.int64()),
                 pa.array([a for _, a in ends], pa.string())], names=[*columns, "cost", "audit"])

    kept = [f for f in SEGMENTS.split(", ") if f.split()[0] not in ("rows", "paths")]
    names = [f.split()[0] for f in kept]
    long_ones = materialize(folded.select(*names, "paths").mapInArrow(
        finish, ", ".join([*kept, "cost long", "audit string"])), "finished")
    totals = whole.select(*names, "cost", "audit").unionByName(long_ones)

    sizes = pieces.groupBy(*KEYS).agg(F.sort_array(F.collect_list(F.struct("seg", F.size("rows").alias("n")))).alias("parts"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for audit, parts in zip(batch.column("audit").to_pylist(), batch.column("parts").to_pylist()):
                yield _split(audit, [(p["seg"], p["n"]) for p in parts])

    cut = long_ones.select(*KEYS, "audit").join(sizes, KEYS).select("audit", "parts").mapInArrow(
        split, "seg long, part string, state int")
    parts = whole.select(*KEYS, "seg", "rows", F.col("audit").alias("part"), F.lit(0).alias("state")).unionByName(
        pieces.select(*KEYS, "seg", "rows").join(cut, "seg"))
    return totals, parts


def _split(audit: str, sizes: list[tuple[int, int]]) -> pa.RecordBatch:
    """The audit of a conversation cut at its segments: inserts belong to the
    row after them, those at the end to the last segment."""
    at, state = 0, 0
    out: list[tuple[int, str, int]] = []
    for i, (seg, n) in enumerate(sizes):
        begin, began = at, state
        while n or (i == len(sizes) - 1 and at < len(audit)):
            n -= audit[at] != "I"
            state = _step(state, audit[at])
            at += 1
        out.append((seg, audit[begin:at], began))
    return pa.RecordBatch.from_arrays(
        [pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.string()),
         pa.array([o[2] for o in out], pa.int32())], names=["seg", "part", "state"])


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each row that stays or is inserted."""
    for batch in batches:
        out: list[tuple] = []
        for no_id, conv, seg, rows, part, state in zip(*(batch.column(c).to_pylist() for c in (
                "no_id", "conv", "seg", "rows", "part", "state"))):
            left = iter(rows)
            for at, letter in enumerate(part):
                row = None if letter == "I" else next(left)
                state = _step(state, letter)
                if letter != "D":
                    out.append((no_id, conv, seg, at, "K" if letter == "J" else letter,
                                ROLE_TO[state] if letter in "IR" else None, row))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(list(zip(*out)) or [()] * 7, kinds)],
            names=["no_id", "conv", "seg", "at", "edit", "given", "row"])


def repair(rows: DataFrame, segment: int = SEGMENT, fold: int = FOLD) -> Repair:
    """``rows``: conv_id, turn, role, text.  The summary has conv_id, gaps,
    blank, duplicate, truncated, illegal, cost and audit; the turns conv_id,
    seg and at (their order), edit, role and text."""
    bounded_batches(rows.sparkSession)
    numbered = _numbered(rows)
    totals, parts = _solve(numbered, segment, fold)
    edits = materialize(parts.mapInArrow(
        _edits, "no_id long, conv long, seg long, at int, edit string, given string, row long"), "edits")
    kept = edits.where("row is not null").join(numbered.select("row", "role", "text"), "row").select(
        *KEYS, "seg", "at", "edit", F.coalesce("given", "role").alias("role"), "text")
    turns = kept.unionByName(edits.where("row is null").select(
        *KEYS, "seg", "at", "edit", F.col("given").alias("role"), F.lit("").alias("text")))
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0).cast("long"))
    return Repair(
        totals.select(_conv_id(), gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost",
                      F.translate("audit", "J", "K").alias("audit")),
        turns.select(_conv_id(), "seg", "at", "edit", "role", "text"))


def _conv_id() -> Column:
    return F.when(F.col("no_id") == 0, F.col("conv")).alias("conv_id")


def digests(turns: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256: each conversation's ``role:text`` lines, joined
    by newlines, streamed through the digest in order."""
    def run(key: tuple[int, int], slices: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = hashlib.sha256()
        first = True
        for batch in slices:
            for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist()):
                made.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                first = False
        yield pa.RecordBatch.from_pydict({"conv_id": pa.array([None if key[0] else key[1]], pa.int64()),
                                          "repaired_sha256": [made.hexdigest()]})

    keyed = turns.select(F.col("conv_id").isNull().cast("long").alias("no_id"),
                         F.coalesce("conv_id", F.lit(0).cast("long")).alias("conv"), "seg", "at", "role", "text")
    return grouped(keyed, ("no_id", "conv"), ("seg", "at"), run, "conv_id long, repaired_sha256 string")


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """Every conv_id of ``conversations`` with the summary and digest of its
    repair after ``damage``; zeros, an empty audit and the digest of nothing
    where no rows are left."""
    done = repair(damage(conversations))
    summary = done.summary
    zeros = {c: F.coalesce(c, F.lit(0).cast("long")) for c in
             ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    all_ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()

    def by_id(left: DataFrame, right: DataFrame) -> DataFrame:
        right = right.withColumnRenamed("conv_id", "own_id")
        return left.join(right, F.col("conv_id").eqNullSafe(F.col("own_id")), "left").drop("own_id")

    return by_id(by_id(all_ids, summary), digests(done.turns)).select(
        "conv_id", *[v.alias(c) for c, v in zeros.items()], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
