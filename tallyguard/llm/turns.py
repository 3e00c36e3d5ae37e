"""Conversation structure repair: the cheapest edits that make the roles alternate, by Viterbi with
survivor coalescence.

A conversation is well formed if its role initials read ``(s?(ua)+)?``. Its rows are taken by turn;
each is kept, given the role that fits, or deleted, and empty rows are inserted where that is
cheaper. One survivor per state of that pattern is carried from row to row as a leaf of a tree of
back-pointers whose nodes count their references. As soon as all survivors descend from one node,
the edits up to it are emitted and forgotten, so what is held is the unresolved part only.
Survivors of equal cost are compared by their whole unresolved edits. A survivor that another one
could follow at less cost, whatever comes, is given up.

Rows are dealt by conversation and sorted inside the partition; a conversation of any length
streams through its task, and only its unresolved rows and its audit letters are held (the letters
only where a summary is asked for). Copies are found by a digest aggregated beforehand, so no task
holds the texts of a conversation.

Null roles and texts count as one space; null turns come first; rows of a null key are one
conversation; rows of equal turns are taken by role, then text; a blank text is any without a
character other than ASCII white space; an empty table gives an empty table; other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1
SPACES, ENDS = " \t\n\x0b\x0c\r", ".!?"
LEGAL = {"su", "ua", "au"}
# States: nothing yet, after system, after user, after assistant. Where each initial leads, and the
# one role that may be inserted or given in a state.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
FITTING = ["user", "user", "assistant", "user"]
# What it costs at most to go on from the first state (row) as well as from the second (column):
# inserts that reach it, and the deletion of a system row that only the start can take.
FOLLOWS = [[0, 0, 2, 0], [7, 0, 2, 4], [5, 2, 0, 2], [3, 0, 2, 0]]
ROWS_PER_BATCH = 4096

DAMAGES = 20
SUMMARY = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


class Node:
    """An edit in the tree of back-pointers, counted by its children and by the survivors that end in it."""

    __slots__ = ("parent", "edit", "role", "text", "depth", "children", "survivors")

    def __init__(self, parent: Node | None, edit: str, role: str | None, text: str | None):
        self.parent, self.edit, self.role, self.text = parent, edit, role, text
        self.children: set[Node] = set()
        self.survivors = 0
        self.depth = parent.depth + 1 if parent else 0
        if parent:
            parent.children.add(self)


def release(node: Node | None) -> None:
    """Forget nodes that nothing refers to any more."""
    while node is not None and node.parent is not None and not node.children and not node.survivors:
        parent, node.parent = node.parent, None
        parent.children.discard(node)
        node = parent


def before(a: Node, b: Node) -> bool:
    """Whether the edits that lead to ``a`` are ASCII-less than those to ``b``, from where they part."""
    left, right = [], []
    while a is not b:
        if a.depth >= b.depth:
            left.append(a.edit)
            a = a.parent
        else:
            right.append(b.edit)
            b = b.parent
    return left[::-1] < right[::-1]


class Repair:
    """One conversation's survivors. ``emit(edit, role, text)`` gets the settled edits in order; a
    deleted row comes with nulls."""

    def __init__(self, emit: Callable[[str, str | None, str | None], None]):
        self.emit = emit
        self.root = Node(None, "", None, None)
        self.alive: dict[int, tuple[int, Node]] = {}
        self._settle({START: (0, self.root)})

    def _offer(self, found: dict, state: int, cost: int, node: Node) -> bool:
        old = found.get(state)
        if old is None or cost < old[0] or (cost == old[0] and before(node, old[1])):
            found[state] = (cost, node)
            return True
        return False

    def _settle(self, found: dict[int, tuple[int, Node]]) -> None:
        """Insertions, the survivors worth following, and the edits they agree on."""
        made = [node for _, node in found.values()]
        changed = list(found)
        while changed:
            state = changed.pop()
            cost, node = found[state]
            role = FITTING[state]
            extra = Node(node, INSERT, role, "")
            made.append(extra)
            after = NEXT[state, role[0]]
            if self._offer(found, after, cost + INSERT_COST, extra):
                changed.append(after)
        kept = {
            s: (c, n) for s, (c, n) in found.items() if all(c <= d + FOLLOWS[t][s] for t, (d, _) in found.items())
        }
        for _, node in kept.values():
            node.survivors += 1
        for _, node in self.alive.values():
            node.survivors -= 1
        for node in [*made, *(n for _, n in self.alive.values())]:
            release(node)
        self.alive = kept
        # Everything alive goes through the root's only child.
        while not self.root.survivors and len(self.root.children) == 1:
            (self.root,) = self.root.children
            self.root.parent = None
            self.emit(self.root.edit, self.root.role, self.root.text)

    def row(self, role: str, text: str, must_go: bool, truncated: bool) -> None:
        found: dict[int, tuple[int, Node]] = {}
        extra = TRUNCATED_COST if truncated else 0
        tried = []
        for state, (cost, node) in self.alive.items():
            options = [(state, cost + DELETE_COST, DELETE, None, None)]
            if not must_go:
                after = NEXT.get((state, role[:1]))
                if after is not None:
                    options.append((after, cost + extra, KEEP, role, text))
                fitting = FITTING[state]
                after = NEXT[state, fitting[0]]
                options.append((after, cost + REROLE_COST + extra, REROLE, fitting, text))
            for after, total, edit, new_role, new_text in options:
                if after in found and total > found[after][0]:
                    continue
                made = Node(node, edit, new_role, new_text)
                tried.append(made)
                self._offer(found, after, total, made)
        chosen = {id(n) for _, n in found.values()}
        for node in tried:
            if id(node) not in chosen:
                release(node)
        self._settle(found)

    def end(self) -> int:
        """Settle all edits; the cost."""
        best: dict[int, tuple[int, Node]] = {}
        for state in (START, ASSISTANT):
            if state in self.alive:
                self._offer(best, 0, *self.alive[state])
        cost, node = best[0]
        path = []
        while node is not self.root:
            path.append(node)
            node = node.parent
        for n in reversed(path):
            self.emit(n.edit, n.role, n.text)
        return cost


@dataclass
class Conversation:
    """What is counted of one conversation, beside its survivors."""

    key: object
    emit: Callable[[str, str | None, str | None], None]

    def __post_init__(self):
        self.repair = Repair(self.emit)
        self.low = self.high = self.last_turn = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.last_role = None
        self.repeated: set[bytes] = set()
        self.last_digest = None
        self.place = None

    def at(self, known: bool, turn: int) -> None:
        """Go to a turn; what was noted for the one before is forgotten."""
        if self.place != (known, turn):
            self.place, self.repeated, self.last_digest = (known, turn), set(), None

    def row(self, known: bool, turn: int, role: str, text: str, digest: bytes) -> None:
        if known and (self.high is None or turn != self.high):
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = turn
        if self.last_role is not None and self.last_role[:1] + role[:1] not in LEGAL:
            self.illegal += 1
        self.last_role = role
        core = text.rstrip(SPACES)
        blank = not core
        copied = not blank and (digest in self.repeated or digest == self.last_digest)
        cut = not blank and not copied and core[-1] not in ENDS
        self.blank, self.duplicate, self.truncated = self.blank + blank, self.duplicate + copied, self.truncated + cut
        self.last_digest = digest
        self.repair.row(role, text, blank or copied, cut)

    def gaps(self) -> int:
        return 0 if self.high is None else self.high - self.low + 1 - self.turns


def damaged(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows with faults put in by a checksum of key and turn: lost (column ``dropped``), emptied,
    without sentence ends, repeated, or said by the user."""
    part = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (key, turn, role, text)]
    kind = F.crc32(F.concat(part[0], F.lit(":"), part[1])) % DAMAGES
    new_text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(part[3], "[.!?]", "")).otherwise(part[3])
    made = F.struct(
        F.when(kind == 4, "user").otherwise(part[2]).alias(role), new_text.alias(text), (kind == 0).alias("dropped")
    )
    return rows.select(F.col(key).alias(key), F.col(turn).alias(turn), F.inline(F.array_repeat(made, F.when(kind == 3, 2).otherwise(1))))


def _ordered(rows: DataFrame, key: str, turn: str, role: str, text: str, dropped: Column) -> DataFrame:
    """Rows and marks of copies, dealt by conversation and sorted. A mark (kind 0) names the digest
    of a text that an earlier turn of the conversation has; rows are kind 1, lost ones 2."""
    number = F.col(turn).cast("bigint")
    named = rows.select(
        F.col(key).alias("key"),
        number.isNotNull().alias("known"),
        F.coalesce(number, F.lit(0).cast("bigint")).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"),
        F.when(dropped, 2).otherwise(1).alias("kind"),
    )
    size = F.length(F.col("role")).cast("string")
    named = named.withColumn("digest", F.unhex(F.sha2(F.concat(size, F.lit(":"), "role", "text"), 256)))
    kept = named.filter("kind = 1").select("key", F.struct("known", "turn").alias("place"), "digest")
    several = kept.groupBy("key", "digest").agg(F.min("place").alias("first"), F.max("place").alias("last"))
    several = several.filter(F.col("first") < F.col("last")).select(
        F.col("key").alias("of"), F.col("digest").alias("seen"), "first"
    )
    again = kept.join(several, F.col("key").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("seen")))
    again = again.filter(F.col("place") > F.col("first")).select("key", "place.*", "digest").distinct()
    nothing = F.lit("")
    marks = again.select("key", "known", "turn", nothing.alias("role"), nothing.alias("text"), F.lit(0).alias("kind"), "digest")
    both = named.unionByName(marks)
    return both.repartition("key").sortWithinPartitions("key", "known", "turn", "kind", "role", "text")


def _streamed(batches: Iterator[pa.RecordBatch], start: Callable, finish: Callable) -> Iterator[None]:
    """Run every conversation of a partition; yields after each batch of rows."""
    current = None
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(7)]
        for key, known, turn, role, text, kind, digest in zip(*columns):
            if current is None or current.key != key:
                if current is not None:
                    finish(current)
                current = start(key)
            current.at(known, turn)
            if kind == 0:
                current.repeated.add(digest)
            elif kind == 1:
                current.row(known, turn, role, text, digest)
            yield
    if current is not None:
        finish(current)
    yield


def _schema(rows: DataFrame, key: str, rest: str) -> T.StructType:
    return T.StructType([T.StructField(key, rows.schema[key].dataType), *T.StructType.fromDDL(rest).fields])


def _arrow(found: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    target = to_arrow_schema(schema)
    arrays = [pa.array([r[i] for r in found], f.type) for i, f in enumerate(target)]
    return pa.RecordBatch.from_arrays(arrays, schema=target)


def summaries(
    rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    dropped: Column | None = None,
) -> DataFrame:
    """Per conversation: gaps between turns, faults by kind, illegal neighbours, the cost, the edits'
    initials and the digest of the repaired rows. Rows where ``dropped`` holds only name their conversation."""
    schema = _schema(rows, key, SUMMARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []

        def start(value):
            letters, digest, first = [], hashlib.sha256(), [True]

            def emit(edit, new_role, new_text):
                letters.append(edit)
                if new_role is not None:
                    digest.update(f"{'' if first[0] else chr(10)}{new_role}:{new_text}".encode())
                    first[0] = False

            made = Conversation(value, emit)
            made.letters, made.digest = letters, digest
            return made

        def finish(c):
            cost = c.repair.end()
            counts = (c.gaps(), c.blank, c.duplicate, c.truncated, c.illegal, cost)
            done.append((c.key, *counts, "".join(c.letters), c.digest.hexdigest()))

        for _ in _streamed(batches, start, finish):
            if len(done) >= ROWS_PER_BATCH:
                yield _arrow(done, schema)
                done.clear()
        yield _arrow(done, schema)

    lost = F.lit(False) if dropped is None else dropped
    return _ordered(rows, key, turn, role, text, lost).mapInArrow(run, schema)


def repaired(
    rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    dropped: Column | None = None,
) -> DataFrame:
    """The repaired rows: key, ``position`` (gapless from 0), role, text and the ``edit`` each came by."""
    schema = _schema(rows, key, "position bigint, role string, text string, edit string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def start(value):
            place = [0]

            def emit(edit, new_role, new_text):
                if new_role is not None:
                    out.append((value, place[0], new_role, new_text, edit))
                    place[0] += 1

            return Conversation(value, emit)

        for _ in _streamed(batches, start, lambda c: c.repair.end()):
            if len(out) >= ROWS_PER_BATCH:
                yield _arrow(out, schema)
                out.clear()
        yield _arrow(out, schema)

    lost = F.lit(False) if dropped is None else dropped
    return _ordered(rows, key, turn, role, text, lost).mapInArrow(run, schema)
