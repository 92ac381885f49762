"""Repair of the structure of conversations by cheapest edits.

A conversation should read ``(s?(ua)+)?`` by the initials of its roles: system
first if at all, then user and assistant in turn. Rows may be kept, given the
role that is due, or deleted, and empty turns may be inserted; the cheapest such
edits are found by Viterbi over four states, what the last kept row was.

Rows arrive sorted, one conversation after another, and are never gathered. Each
state has one survivor, a node of a tree of back pointers. A node is dropped when
no child and no survivor refers to it, and once the root has a single child, all
survivors share that child: its edits are settled and leave. What waits is one
short string a row and branch; texts never wait, as each survivor carries its own
running hash.

Of equally cheap edits those whose initials come first in ASCII win, compared over
their whole lengths. Two survivors end in the edit of the same row, so neither's
initials are the beginning of the other's, and the first difference between them
decides for all that may follow. The order of the survivors' whole unresolved
initials is therefore kept as a rank beside their costs, and a tie between steps
is settled by (rank, step) without reading the strings again.
"""

from __future__ import annotations

import hashlib
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
# What must come next after each state, and its role.
NEXT = (USER, USER, ASSISTANT, USER)
ROLES = ("", "system", "user", "assistant")
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
RETYPE, DELETE, INSERT, CUT_OFF = 2, 3, 2, 1
# No more than two inserted rows in a row can be part of cheapest edits.
MOST_INSERTS = 2
# Whatever may follow one state may follow another too, for an inserted row that ends
# an open turn and the deletion of a system row. A survivor dearer by more is lost.
SLACK = INSERT + DELETE
SPACES = " \t\n\x0b\x0c\r"
ENDS = ".!?"

Costs = tuple[int | None, ...]


@cache
def moves(initial: str, fault: int) -> tuple[tuple[int, str, int, int], ...]:
    """(state before, edits' initials, cost, state after) over one row."""
    found = []
    for before in range(4):
        state = before
        for n in range(MOST_INSERTS + 1):
            state = NEXT[state] if n else state
            step, cost, due = "I" * n, INSERT * n, NEXT[state]
            found.append((before, step + "D", cost + DELETE, state))
            if fault in (BLANK, DUPLICATE):
                continue
            cost += CUT_OFF if fault == TRUNCATED else 0
            found.append((before, step + "R", cost + RETYPE, due))
            if initial == ROLES[due][0]:
                found.append((before, step + "K", cost, due))
            elif initial == "s" and state == NOTHING:
                found.append((before, step + "K", cost, SYSTEM))
    return tuple(found)


@cache
def advanced(costs: Costs, ranks: Costs, initial: str, fault: int):
    """Survivors after a row: added cost, [(after, before, step)], costs, ranks.

    Costs are given above the least one, so there are few different arguments
    and each is worked out once.
    """
    best: dict[int, tuple] = {}
    for before, step, cost, after in moves(initial, fault):
        if costs[before] is not None:
            way = (costs[before] + cost, ranks[before], step, before)
            if after not in best or way < best[after]:
                best[after] = way
    least = min(way[0] for way in best.values())
    best = {after: way for after, way in best.items() if way[0] <= least + SLACK}
    order = sorted(best, key=lambda after: best[after][1:3])
    return (
        least,
        [(after, way[3], way[2]) for after, way in best.items()],
        tuple(best[s][0] - least if s in best else None for s in range(4)),
        tuple(order.index(s) if s in best else None for s in range(4)),
    )


def _after_inserts(state: int, step: str) -> list[int]:
    """The states that the insertions of a step lead through."""
    through = []
    for _ in range(step.count("I")):
        state = NEXT[state]
        through.append(state)
    return through


class Node:
    __slots__ = ("parent", "step", "before", "after", "children", "survivor")

    def __init__(self, parent: Node | None, step: str, before: int, after: int):
        self.parent, self.step, self.before, self.after = parent, step, before, after
        self.children: list[Node] = []
        self.survivor = True

    def references(self) -> int:
        return len(self.children) + self.survivor


class Survivors:
    """Viterbi over the rows of one conversation, fed one at a time.

    ``settled`` takes (edits' initials, state before, state after) of each row, in
    order, as soon as no later row can change them.
    """

    def __init__(self, settled, hashed: bool):
        self.settled = settled
        self.root = Node(None, "", NOTHING, NOTHING)
        self.nodes = {NOTHING: self.root}
        self.cost = 0
        self.costs: Costs = (0, None, None, None)
        self.ranks: Costs = (0, None, None, None)
        self.hashes = {NOTHING: hashlib.sha256()} if hashed else None

    def take(self, initial: str, fault: int, role: bytes, text: bytes) -> None:
        added, ways, self.costs, self.ranks = advanced(self.costs, self.ranks, initial, fault)
        self.cost += added
        nodes = {}
        for after, before, step in ways:
            parent = self.nodes[before]
            nodes[after] = child = Node(parent, step, before, after)
            parent.children.append(child)
        if self.hashes is not None:
            self.hashes = {
                after: self._hash(before, step, role, text) for after, before, step in ways
            }
        for node in self.nodes.values():
            node.survivor = False
            while not node.references() and node.parent is not None:
                node.parent.children.remove(node)
                node = node.parent
        self.nodes = nodes
        while self.root.references() == 1 and not self.root.survivor:
            self.root = self.root.children[0]
            self.root.parent = None
            self.settled(self.root.step, self.root.before, self.root.after)

    def _hash(self, state: int, step: str, role: bytes = b"", text: bytes = b""):
        """The running hash of a survivor with one more step; hashes are never changed."""
        so_far = self.hashes[state]
        if step == "D":
            return so_far
        grown = so_far.copy()
        mark = b"\n" if state != NOTHING else b""
        for state in _after_inserts(state, step):
            grown.update(mark + ROLES[state].encode() + b":")
            mark = b"\n"
        if step.endswith("R"):
            role = ROLES[NEXT[state]].encode()
        if step.endswith(("R", "K")):
            grown.update(mark + role + b":")
            grown.update(text)
        return grown

    def finish(self) -> tuple[int, bytes | str]:
        """Settles the rest; the cost of all edits and the hash of the repaired rows."""
        ends = [(NOTHING, ""), (ASSISTANT, ""), (USER, "I"), (SYSTEM, "II")]
        cost, _, step, state = min(
            (self.costs[s] + INSERT * len(step), self.ranks[s], step, s)
            for s, step in ends
            if self.costs[s] is not None
        )
        rest, node = [], self.nodes[state]
        while node is not self.root:
            rest.append(node)
            node = node.parent
        for node in reversed(rest):
            self.settled(node.step, node.before, node.after)
        if step:
            self.settled(step, state, ASSISTANT)
        digest = self._hash(state, step or "D").hexdigest() if self.hashes is not None else ""
        return self.cost + cost, digest


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with planted faults, for tests of a repair.

    By crc32 of ``conv_id:turn``, modulo 20, a row is dropped (0), emptied (1),
    left without its sentence ends (2), repeated (3) or given to the user (4). A
    null in that key, a null role and a null text count as one space. A dropped
    row stays with ``gone`` true and no text, so that its conversation is known.
    """

    def spaced(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    key = F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")
    kind = F.crc32(key) % 20
    cut = rows.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), kind.alias("kind"))
    text = (
        F.when(F.col("kind").isin(0, 1), "")
        .when(F.col("kind") == 2, F.translate("text", ENDS, ""))
        .otherwise(F.col("text"))
    )
    return cut.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        (F.col("kind") == 0).alias("gone"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def marked(rows: DataFrame) -> DataFrame:
    """Rows with their first fault, each conversation whole and in order in one task.

    Takes conv_id, turn, role, text and, if it is there, ``gone`` for rows that
    only tell of their conversation; adds fault, and place, the row's number in its
    conversation. Order is by turn, nulls first, then role and text, so rows that
    tie are equal. Null roles and texts count as one space; other columns are
    dropped. One shuffle, by conversation; a long one streams through its task,
    as the hash of its text must, and both sorts and the windows can spill.
    """
    if "gone" not in rows.columns:
        rows = rows.withColumn("gone", F.lit(False))
    cut = rows.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        "gone",
    ).repartition("conv_id")
    seen = Window.partitionBy("conv_id", "gone", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    bare = F.rtrim(F.col("text"), F.lit(SPACES))
    fault = (
        F.when(bare == "", BLANK)
        .when(F.row_number().over(seen) > 1, DUPLICATE)
        .when(~F.right(bare, F.lit(1)).isin(*ENDS), TRUNCATED)
        .otherwise(SOUND)
    )
    # Of equal rows of a turn the first is no duplicate.
    order = [F.col("turn").asc_nulls_first(), "role", "text", F.col("fault") == DUPLICATE]
    with_fault = cut.withColumn("fault", fault)
    placed = F.row_number().over(Window.partitionBy("conv_id", "gone").orderBy(*order)) - 1
    return with_fault.withColumn("place", placed).sortWithinPartitions("conv_id", *order)


KINDS = "turn", "gone", "fault", "role", "text"


def _conversations(batches):
    """(number of the conversation in the task, its id, rows) of sorted batches, in parts."""
    number, last = -1, object()
    for batch in batches:
        ids = batch.column("conv_id").to_pylist()
        columns = zip(*(batch.column(c).to_pylist() for c in KINDS))
        start, rows = 0, list(columns)
        for i, key in enumerate(ids):
            if key != last:
                if i > start:
                    yield number, last, rows[start:i]
                number, last, start = number + 1, key, i
        if rows:
            yield number, last, rows[start:]


class _Report:
    """What is counted of one conversation beside its edits."""

    def __init__(self, key):
        self.key = key
        self.faults = [0, 0, 0, 0]
        self.first = self.turn = None
        self.turns = self.illegal = 0
        self.previous = None
        self.audit: list[str] = []
        self.path = Survivors(lambda step, *_: self.audit.append(step), hashed=True)

    def take(self, turn, fault: int, role: bytes, text: bytes) -> None:
        initial = role.decode()[:1]
        self.faults[fault] += 1
        if turn is not None and turn != self.turn:
            self.first = turn if self.first is None else self.first
            self.turn, self.turns = turn, self.turns + 1
        if self.previous is not None:
            self.illegal += self.previous + initial not in ("su", "ua", "au")
        self.previous = initial
        self.path.take(initial, fault, role, text)

    def row(self) -> tuple:
        cost, digest = self.path.finish()
        gaps = self.turn - self.first + 1 - self.turns if self.turns else 0
        return (self.key, gaps, *self.faults[1:], self.illegal, cost, "".join(self.audit), digest)


AUDITED = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def audited(rows: DataFrame) -> DataFrame:
    """One row a conversation: its faults, and what its cheapest repair does.

    gaps counts turns missing between the first and the last, without null turns;
    blank, duplicate and truncated count rows by their first fault; illegal counts
    neighbours whose initials don't follow each other. audit has an initial for each
    edit (Keep, Rerole, Delete, Insert) and repaired_sha256 is the SHA-256 of the
    repaired ``role:text`` rows joined by newlines. A conversation of which all rows
    are gone has zeros, no edits and the hash of nothing; a null conv_id is a
    conversation too, and an empty table gives no rows.
    """

    def run(batches):
        kind = out.schema_arrow
        done, report, current = [], None, -1
        for number, key, part in _conversations(batches):
            if number != current:
                if report is not None:
                    done.append(report.row())
                if len(done) >= 1000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), kind)], schema=kind)
                    done = []
                report, current = _Report(key), number
            for turn, gone, fault, role, text in part:
                if not gone:
                    report.take(turn, fault, role, text)
        if report is not None:
            done.append(report.row())
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), kind)], schema=kind)

    id_type = rows.schema["conv_id"].dataType
    schema = f"conv_id {id_type.simpleString()}, {', '.join(f'{c} long' for c in AUDITED)}, audit string, repaired_sha256 string"
    out = _Schema(id_type)
    binary = [F.col(c).cast("binary").alias(c) for c in ("role", "text")]
    return marked(rows).select("conv_id", "turn", "gone", "fault", *binary).mapInArrow(run, schema)


class _Schema:
    def __init__(self, id_type):
        from pyspark.sql.pandas.types import to_arrow_type

        self.schema_arrow = pa.schema(
            [("conv_id", to_arrow_type(id_type)), *((c, pa.int64()) for c in AUDITED), ("audit", pa.string()), ("repaired_sha256", pa.string())]
        )


def edits(rows: DataFrame) -> DataFrame:
    """The cheapest edits, a row for each row of the input and one for inserts at the end.

    conv_id, place, inserted (initials of roles to insert before the row), edit (K,
    R or D; null at the end) and role, the row's role if it gets another. Rows leave
    as soon as they are settled.
    """
    id_type = rows.schema["conv_id"].dataType

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        kind = pa.schema(
            [("conv_id", to_arrow_type(id_type)), ("place", pa.int64()), ("inserted", pa.string()), ("edit", pa.string()), ("role", pa.string())]
        )
        done: list[tuple] = []
        path, current, place, key = None, -1, 0, None

        def settled(step: str, before: int, after: int) -> None:
            nonlocal place
            through = _after_inserts(before, step)
            edit = step[-1] if step[-1] != "I" else None
            role = ROLES[after] if edit == "R" else None
            done.append((key, place, "".join(ROLES[s][0] for s in through), edit, role))
            place += 1

        def batch():
            made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), kind)], schema=kind)
            done.clear()
            return made

        for number, next_key, part in _conversations(batches):
            if number != current:
                if path is not None:
                    path.finish()
                path, current, place, key = Survivors(settled, hashed=False), number, 0, next_key
            for _, gone, fault, role, text in part:
                if not gone:
                    path.take(role.decode()[:1], fault, role, text)
                if len(done) >= 10_000:
                    yield batch()
        if path is not None:
            path.finish()
        if done:
            yield batch()

    binary = [F.col("role").cast("binary").alias("role"), F.lit(b"").alias("text")]
    schema = f"conv_id {id_type.simpleString()}, place long, inserted string, edit string, role string"
    return marked(rows).select("conv_id", "turn", "gone", "fault", *binary).mapInArrow(run, schema)


def repaired(rows: DataFrame) -> DataFrame:
    """The conversations after their cheapest edits: conv_id, place, role, text, edit.

    place numbers the repaired rows; a null role or text of a kept row is one space.
    """
    given = marked(rows).where(~F.col("gone")).select("conv_id", "place", F.col("role").alias("had"), "text")
    both = edits(rows).alias("e").join(
        given.alias("g"),
        F.col("e.conv_id").eqNullSafe(F.col("g.conv_id")) & (F.col("e.place") == F.col("g.place")),
        "left",
    )
    full = F.create_map(*[F.lit(x) for r in ("user", "assistant") for x in (r[0], r)])
    new = F.transform(
        F.split("inserted", ""),
        lambda c: F.struct(full[c].alias("role"), F.lit("").alias("text"), F.lit("I").alias("edit")),
    )
    kept = F.array(F.struct(F.coalesce("role", "had").alias("role"), F.col("text"), F.col("edit")))
    none = F.expr("array()").cast("array<struct<role:string,text:string,edit:string>>")
    all_rows = F.concat(
        F.when(F.col("inserted") == "", none).otherwise(new),
        F.when(F.col("edit").isin("K", "R"), kept).otherwise(none),
    )
    listed = both.select("e.conv_id", F.col("e.place").alias("old"), F.posexplode(all_rows).alias("seq", "row"))
    order = Window.partitionBy("conv_id").orderBy("old", "seq")
    return listed.select("conv_id", (F.row_number().over(order) - 1).alias("place"), "row.role", "row.text", "row.edit")
