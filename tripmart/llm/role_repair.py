"""Operator 11: conversation structure repair by a generalised LR parse.

The roles of a conversation must follow ``GRAMMAR``. Its LR automaton is built
from the productions; a row may be kept, reroled or deleted and rows may be
inserted, each at a cost. All edits are followed at once in a graph-structured
stack: stacks share their lower parts (``Node``), and equal stack tops are
merged by the minimum of (cost, audit), where the audit is the string of the
edits' initials (Keep, Rerole, Delete, Insert), compared as ASCII.

Merging is exact: after the n-th row no audit is a proper prefix of another
(both end with the edit of that row), so of two audits on one top the smaller
stays the smaller whatever follows. Audits are therefore compared by the rank of
their parents and the step that follows, and are only written out at the end.
The same holds for the repaired text: each top carries the SHA-256 state of its
own repaired rows, so a conversation is read once.

Conversations are hash-partitioned and sorted by turn, and every task streams its
rows: of a conversation it holds a byte pair per row and top (for the audit,
which is as long as the conversation) and the keys of texts that occur twice or
more in it, which are found by a partially aggregated count beforehand; texts
are never gathered. SHA-256 chains over a whole conversation, so its rows pass
through one task, one after another; nothing in it grows but those bytes.

Faults, the first that holds counts: blank (no character beyond ASCII white
space), duplicate (role and text seen earlier in the conversation), truncated
(the last such character is not ``.``, ``!`` or ``?``).

Defined results: NULL columns read as one space; a NULL conv_id is a
conversation of its own; a NULL turn sorts first and counts in no gap; rows of
one turn are ordered by role and text; repeated rows are duplicates; a role is
known by its first character and an unknown one cannot be kept; a conversation
without rows has zeros, an empty audit and the hash of the empty string; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_partitions

# fixed values: the role grammar, `(s?(ua)+)?` over role initials, left
# recursive so that stacks stay short
GRAMMAR = {
    "Conversation": [(), ("Turns",), ("s", "Turns")],
    "Turns": [("Turns", "Turn"), ("Turn",)],
    "Turn": [("u", "a")],
}
START = "Conversation"
ROLES = {"u": "user", "a": "assistant"}  # what a row may be reroled to and inserted as
LEGAL_NEIGHBOURS = {"su", "ua", "au"}
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
BLANKS = " \t\n\v\f\r"

Item = tuple[str, tuple[str, ...], int]  # a production with a dot


@dataclass(eq=False)
class Node:
    """A stack: an LR state on top of another stack."""

    state: frozenset[Item]
    below: Node | None
    above: dict[frozenset[Item], Node] = field(default_factory=dict)

    def push(self, state: frozenset[Item]) -> Node:
        """The one stack with ``state`` on top of this one."""
        if state not in self.above:
            self.above[state] = Node(state, self)
        return self.above[state]


class Parser:
    """Generalised LR over a grammar, with the edits worked into its moves."""

    def __init__(self, grammar: dict[str, list[tuple[str, ...]]] = GRAMMAR, start: str = START):
        self.grammar, self.start = grammar, start
        self.tops: list[Node] = []
        self.number: dict[Node, int] = {}
        self._shifts: dict[tuple[int, str], list[int]] = {}
        self._inserts: dict[int, list[tuple[int, int, str]]] = {}
        self._moves: dict[tuple[int, str, bool, bool], list[tuple]] = {}
        root = Node(self._closure({("", (start,), 0)}), None)
        self.first = [self._number(t) for t in self._settled([root])]
        symbols = {x for bodies in grammar.values() for b in bodies for x in b} - set(grammar)
        for top in self.tops:  # grows: all stacks that can be met
            for symbol in sorted(symbols):
                self.shifts(self.number[top], symbol)

    def _closure(self, items: set[Item]) -> frozenset[Item]:
        todo = list(items)
        while todo:
            _, body, dot = todo.pop()
            if dot < len(body):
                for production in self.grammar.get(body[dot], []):
                    new = (body[dot], production, 0)
                    if new not in items:
                        items.add(new)
                        todo.append(new)
        return frozenset(items)

    def _goto(self, state: frozenset[Item], symbol: str) -> frozenset[Item]:
        moved = {(h, b, d + 1) for h, b, d in state if d < len(b) and b[d] == symbol}
        return self._closure(moved) if moved else frozenset()

    def _reduced(self, tops: list[Node]) -> list[Node]:
        """The stacks and all that reductions make of them."""
        found = dict.fromkeys(tops)
        todo = list(found)
        while todo:
            top = todo.pop()
            for head, body, dot in top.state:
                if dot < len(body) or not head:
                    continue
                under = top
                for _ in body:
                    under = under.below
                state = self._goto(under.state, head)
                if state and (new := under.push(state)) not in found:
                    found[new] = None
                    todo.append(new)
        return list(found)

    def _settled(self, tops: list[Node]) -> list[Node]:
        """Stacks that can go on, or end, after the reductions that must be made."""
        def waits(top: Node) -> bool:  # for a symbol, or a reduction left open until then
            return any(d < len(b) and b[d] not in self.grammar for _, b, d in top.state)

        return [t for t in self._reduced(tops) if waits(t)]

    def _number(self, top: Node) -> int:
        if top not in self.number:
            self.number[top] = len(self.tops)
            self.tops.append(top)
        return self.number[top]

    def accepts(self, top: int) -> bool:
        done = ("", (self.start,), 1)
        return any(done in t.state for t in self._reduced([self.tops[top]]))

    def shifts(self, top: int, symbol: str) -> list[int]:
        key = (top, symbol)
        if key not in self._shifts:
            node = self.tops[top]
            state = self._goto(node.state, symbol)
            self._shifts[key] = [self._number(t) for t in self._settled([node.push(state)])] \
                if state else []
        return self._shifts[key]

    def inserts(self, top: int) -> list[tuple[int, int, str]]:
        """(cost, top, inserted roles): the cheapest way to each top by insertions alone."""
        if top not in self._inserts:
            best, todo = {top: (0, "")}, [top]
            while todo:
                here = todo.pop(0)
                for symbol in sorted(ROLES):
                    for there in self.shifts(here, symbol):
                        new = (best[here][0] + INSERT, best[here][1] + symbol)
                        if there not in best or new < best[there]:
                            best[there] = new
                            todo.append(there)
            self._inserts[top] = [(c, t, r) for t, (c, r) in best.items()]
        return self._inserts[top]

    def moves(self, top: int, initial: str, must_go: bool, truncated: bool) -> list[tuple]:
        """(cost, edits, top, inserted roles, new role) of one row: insertions before
        it and its own edit; the least (cost, edits) to each top. The new role is
        None if the row is deleted and empty if its own role stays."""
        key = (top, initial, must_go, truncated)
        if key not in self._moves:
            best: dict[int, tuple] = {}
            for cost, here, added in self.inserts(top):
                edits = "I" * len(added)
                found = [(cost + DELETE, edits + "D", here, added, None)]
                if not must_go:
                    more = cost + TRUNCATED * truncated
                    found += [(more, edits + "K", t, added, "") for t in self.shifts(here, initial)]
                    found += [(more + REROLE, edits + "R", t, added, ROLES[r])
                              for r in ROLES for t in self.shifts(here, r)]
                for move in found:
                    if move[2] not in best or move[:2] < best[move[2]][:2]:
                        best[move[2]] = move
            self._moves[key] = list(best.values())
        return self._moves[key]


_PARSERS: list[Parser] = []


def parser() -> Parser:
    if not _PARSERS:
        _PARSERS.append(Parser())
    return _PARSERS[0]


class _Lines:
    """SHA-256 of lines joined by newlines; ``add`` gives a new object."""

    __slots__ = ("state", "some")

    def __init__(self, state=None, some: bool = False):
        self.state, self.some = state or hashlib.sha256(), some

    def add(self, lines: list[bytes]) -> _Lines:
        state = self.state.copy()
        state.update((b"\n" if self.some else b"") + b"\n".join(lines))
        return _Lines(state, True)


class Conversation:
    """Reads the rows of one conversation in order; ``result`` ends it.

    ``repeated``: the keys of (role, text) that occur more than once in it.
    """

    def __init__(self, repeated: set | None = None):
        self.parser, self.repeated = parser(), repeated if repeated is not None else set()
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.before: str | None = None
        self.turns, self.low, self.high = 0, None, None
        # top -> (cost, rank of its audit, hash); the rank is the order of the audits
        self.tops = {t: (0, 0, _Lines()) for t in self.parser.first}
        self.steps: list[str] = []  # distinct edits between two rows' ends
        self.step_number: dict[str, int] = {}
        self.back = bytearray()  # per row and top: the top before it, and the step
        self.width = 2 * len(self.parser.tops)

    def row(self, turn: int | None, role: str, text: str, key: object = None) -> None:
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low, self.high = (turn if self.low is None else self.low), turn
        initial = role[:1]
        if self.before is not None and self.before + initial not in LEGAL_NEIGHBOURS:
            self.illegal += 1
        self.before = initial
        said = text.strip(BLANKS)
        must_go = truncated = False
        if not said:
            self.blank += 1
            must_go = True
        elif key in self.repeated:
            if (key, 1) in self.repeated:  # seen
                self.duplicate += 1
                must_go = True
            else:
                self.repeated.add((key, 1))
        if not must_go and said[-1] not in ".!?":
            self.truncated += 1
            truncated = True
        best: dict[int, tuple] = {}
        for top, (cost, rank, _) in self.tops.items():
            for move in self.parser.moves(top, initial, must_go, truncated):
                there, new = move[2], (cost + move[0], rank, move[1], top, move)
                if there not in best or new[:3] < best[there][:3]:
                    best[there] = new
        ranks = {k: n for n, k in enumerate(sorted({(b[1], b[2]) for b in best.values()}))}
        body = text.encode("utf-8", "surrogatepass")
        after = {}
        for there, (cost, rank, edits, top, move) in best.items():
            lines = [f"{ROLES[r]}:".encode() for r in move[3]]
            if move[4] is not None:
                lines.append((move[4] or role).encode("utf-8", "surrogatepass") + b":" + body)
            held = self.tops[top][2]
            after[there] = (cost, ranks[rank, edits], held.add(lines) if lines else held)
        self._note({there: (b[3], b[2]) for there, b in best.items()})
        self.tops = after

    def _note(self, came: dict[int, tuple[int, str]]) -> None:
        at = len(self.back)
        self.back += bytes(self.width)
        for top, (before, edits) in came.items():
            if edits not in self.step_number:
                self.step_number[edits] = len(self.steps)
                self.steps.append(edits)
            self.back[at + 2 * top] = before
            self.back[at + 2 * top + 1] = self.step_number[edits]

    def result(self) -> tuple:
        """gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
        ends = []
        for top, (cost, rank, lines) in self.tops.items():
            for more, there, added in self.parser.inserts(top):
                if self.parser.accepts(there):
                    ends.append((cost + more, rank, "I" * len(added), top, added, lines))
        cost, _, edits, top, added, lines = min(ends, key=lambda e: e[:3])
        if added:
            lines = lines.add([f"{ROLES[r]}:".encode() for r in added])
        audit = [edits]
        for at in range(len(self.back) - self.width, -1, -self.width):
            audit.append(self.steps[self.back[at + 2 * top + 1]])
            top = self.back[at + 2 * top]
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return (gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost,
                "".join(reversed(audit)), lines.state.hexdigest())


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, dropped) after the damage, NULLs as one space.

    By crc32 of ``conv_id:turn`` modulo 20: 0 drops the row (it stays, marked,
    so that its conversation is not lost), 1 empties its text, 2 removes its
    ``.``, ``!`` and ``?``, 3 repeats it, 4 sets its role to user.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        space("role").alias("role"), space("text").alias("text"),
        (F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20).alias("_kind"))
    kind = F.col("_kind")
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind <= 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"), (kind == 0).alias("dropped"),
        F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
                  ).alias("_copy")).drop("_copy")


def _ordered(rows: DataFrame) -> DataFrame:
    """Every conversation's repeated keys (kind 0), then its rows (1) in order."""
    live = ~F.col("dropped")
    keyed = rows.select("*", F.when(live, F.xxhash64("role", "text")).alias("key"),
                        F.when(live, F.xxhash64(F.lit("again"), "text", "role")).alias("again"))
    repeated = keyed.filter(live & F.col("text").rlike(r"[^\x20\x09-\x0D]")).groupBy(
        "conv_id", "key", "again").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    none = F.lit(None)
    both = keyed.select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text", "dropped",
                        "key", "again").unionByName(repeated.select(
                            "conv_id", F.lit(0).alias("kind"), none.cast("long").alias("turn"),
                            none.cast("string").alias("role"), none.cast("string").alias("text"),
                            F.lit(False).alias("dropped"), "key", "again"))
    return both.repartition(shuffle_partitions(rows.sparkSession), "conv_id").sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), "kind", F.col("turn").asc_nulls_first(), "role", "text")


SCHEMA = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, "
          "cost long, audit string, repaired_sha256 string")


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text, dropped):
    its faults, and the cheapest edits that give it a legal order of roles."""
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    kinds = [pa.string() if c.endswith("string") else pa.int64() for c in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Conversation | None = None
        conv = None
        for batch in batches:
            out = []
            for conv_id, kind, turn, role, text, dropped, key, again in zip(
                    *(c.to_pylist() for c in batch.columns)):
                if held is None or conv_id != conv:
                    if held is not None:
                        out.append((conv, *held.result()))
                    held, conv = Conversation(), conv_id
                if not kind:
                    held.repeated.add((key, again))
                elif not dropped:
                    held.row(turn, role, text, (key, again))
            yield _table(out, names, kinds)
        if held is not None:
            yield _table([(conv, *held.result())], names, kinds)

    return _ordered(rows).mapInArrow(run, SCHEMA)


def _table(rows: list[tuple], names: list[str], kinds: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)


REPAIRED = "conv_id long, place long, turn long, role string, text string, edit string"


def repaired_rows(rows: DataFrame) -> DataFrame:
    """The repaired conversations: (conv_id, place from 0, turn, role, text, edit) of
    every row that stays, with NULL turns for inserted ones."""
    names = [c.split()[0] for c in REPAIRED.split(", ")]
    kinds = [pa.string() if c.endswith("string") else pa.int64() for c in REPAIRED.split(", ")]
    none = F.lit(None)
    both = rows.filter("NOT dropped").select(
        "conv_id", F.lit(1).alias("kind"), "turn", "role", "text").unionByName(
        repair(rows).select("conv_id", F.lit(0).alias("kind"), none.cast("long").alias("turn"),
                            none.cast("string").alias("role"), F.col("audit").alias("text")))
    ordered = both.repartition(shuffle_partitions(rows.sparkSession), "conv_id").sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), "kind", F.col("turn").asc_nulls_first(), "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, at, place, last = "", 0, 0, None
        for batch in batches:
            out: list[tuple] = []

            def insert(conv: int | None) -> None:
                nonlocal at, place, last
                while at < len(audit) and audit[at] == "I":
                    last = "assistant" if last == "u" else "user"
                    out.append((conv, place, None, last, "", "I"))
                    at, place, last = at + 1, place + 1, last[0]

            for conv, kind, turn, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if not kind:
                    audit, at, place, last = text, 0, 0, None
                else:
                    edit, at = audit[at], at + 1
                    if edit == "R":
                        role = "assistant" if last == "u" else "user"
                    if edit != "D":
                        out.append((conv, place, turn, role, text, edit))
                        place, last = place + 1, role[:1]
                insert(conv)
            yield _table(out, names, kinds)

    return ordered.mapInArrow(run, REPAIRED)
