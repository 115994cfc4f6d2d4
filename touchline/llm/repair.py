"""Conversation structure repair: a Viterbi search whose survivors coalesce.

A conversation is repaired by edits so that its roles read system?, (user, assistant)+, or nothing
is left. Each row is kept, given the role user or assistant, or deleted; rows without text may be
inserted anywhere. Blank rows and rows that were said before have to go. The cheapest edits win, and
of equally cheap ones those whose initials (D, I, K, R) come first in ASCII.

The search goes through the rows once. Each state of the grammar has one survivor, the tip of a path
in a tree of back pointers. A node counts the paths that use it and is freed with its last one; as
soon as all survivors share an ancestor, the edits up to it are final and are given out with their
texts. A state that no cheapest path can pass through any more is dropped, since its survivor would
hold up the others. So memory holds the unresolved rows only, not the conversation. Survivors of
equal cost are ordered by their whole unresolved suffixes; as the order of the paths they extend is
known from the row before, a comparison takes a few steps.

Rows go to the task of their conversation, are sorted there (spilling to disk) and streamed. One
conversation is read in one task, because each choice may hang on all rows before it and what is
asked for is its digest; it is never held whole.

A NULL role or text is one space. Rows go by turn (NULL first), then role and text. A NULL id is a
conversation of its own. Of the input, only the columns of the conversation, turn, role and text are
used, whatever else it has. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from typing import Any, NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Costs, white space, ends of sentences and the grammar of roles.
RELABEL, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
BLANKS = " \t\n\x0b\x0c\r"
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {
    (START, "s"): SYSTEM,
    (START, "u"): USER,
    (SYSTEM, "u"): USER,
    (USER, "a"): ASSISTANT,
    (ASSISTANT, "u"): USER,
}
ACCEPTED = (START, ASSISTANT)
LEGAL = frozenset(("su", "ua", "au"))
NAMES = {"u": "user", "a": "assistant"}

# What follows the second state can follow the first for at most so much more: a system row is deleted instead of kept.
INSTEAD = ((ASSISTANT, START, DELETE), (ASSISTANT, SYSTEM, 0), (START, SYSTEM, 0))


class Turn(NamedTuple):
    turn: int | None
    role: str
    text: str
    fault: str


class Edit(NamedTuple):
    """What is done to a row (or that one is inserted, without ``row``), and the role it then has."""

    kind: str
    row: Turn | None
    role: str | None


class Viterbi:
    """Feed rows with ``push``; it returns the edits that are final by then, ``finish`` the rest."""

    def __init__(self) -> None:
        self.edit: list[Edit | None] = [None]
        self.parent, self.depth = [-1], [0]
        self.uses, self.children = [1], [0]  # paths and tips at a node; the sum of its children's numbers
        self.free: list[int] = []
        self.root, self.cost = 0, 0
        self.tips: dict[int, tuple[int, int]] = {START: (0, 0)}
        self.order: dict[tuple[int, int], bool] = {}
        self._insert()
        self._settle()

    def live(self) -> int:
        """Nodes that are held."""
        return len(self.parent) - len(self.free)

    def _node(self, parent: int, edit: Edit) -> int:
        if self.free:
            node = self.free.pop()
            self.edit[node], self.parent[node], self.depth[node] = edit, parent, self.depth[parent] + 1
            self.uses[node], self.children[node] = 1, 0
        else:
            node = len(self.parent)
            self.edit.append(edit)
            self.parent.append(parent)
            self.depth.append(self.depth[parent] + 1)
            self.uses.append(1)
            self.children.append(0)
        self.uses[parent] += 1
        self.children[parent] += node
        return node

    def _release(self, node: int) -> None:
        """One path less; nodes without a path go."""
        self.uses[node] -= 1
        while node != self.root and not self.uses[node]:
            parent = self.parent[node]
            self.edit[node] = None
            self.free.append(node)
            self.children[parent] -= node
            self.uses[parent] -= 1
            node = parent

    def _before(self, a: int, b: int) -> bool:
        """Whether the edits up to ``a`` come before those up to ``b``; an early end comes first."""
        last_a = last_b = ""
        while a != b:
            known = self.order.get((a, b))
            if known is not None:
                return known
            deeper = self.depth[a] - self.depth[b]
            if deeper >= 0:
                last_a, a = self.edit[a].kind, self.parent[a]
            if deeper <= 0:
                last_b, b = self.edit[b].kind, self.parent[b]
        return last_a < last_b

    def _offer(self, tips: dict[int, tuple[int, int]], state: int, cost: int, parent: int, edit: Edit) -> bool:
        """Make the path the survivor of a state if it is better than the one there."""
        held = tips.get(state)
        if held and held[0] < cost:
            return False
        node = self._node(parent, edit)
        if held and held[0] == cost and not self._before(node, held[1]):
            self._release(node)
            return False
        tips[state] = (cost, node)
        if held:
            self._release(held[1])
        return True

    def _insert(self) -> None:
        """Survivors of states that are reached best by inserting rows."""
        changed = True
        while changed:
            changed = False
            for state in (START, SYSTEM, USER, ASSISTANT):
                if state in self.tips:
                    cost, node = self.tips[state]
                    role = "a" if state == USER else "u"
                    made = Edit("I", None, NAMES[role])
                    changed |= self._offer(self.tips, NEXT[state, role], cost + INSERT, node, made)

    def _settle(self) -> None:
        """Drop hopeless survivors and order the others."""
        for better, state, more in INSTEAD:
            if better in self.tips and state in self.tips and self.tips[better][0] + more < self.tips[state][0]:
                self._release(self.tips.pop(state)[1])
        nodes = [n for _, n in self.tips.values()]
        order = {}
        for i, a in enumerate(nodes):
            for b in nodes[:i]:
                if not self._above(a, b) and not self._above(b, a):
                    order[a, b] = self._before(a, b)
                    order[b, a] = not order[a, b]
        self.order = order

    def _above(self, a: int, b: int) -> bool:
        """Whether ``b`` extends ``a`` by inserted rows."""
        while self.depth[b] > self.depth[a] and self.edit[b].kind == "I":
            b = self.parent[b]
        return a == b

    def push(self, row: Turn) -> list[Edit]:
        tips: dict[int, tuple[int, int]] = {}
        more = TRUNCATED if row.fault == "truncated" else 0
        initial = row.role[:1]
        for state, (cost, node) in self.tips.items():
            self._offer(tips, state, cost + DELETE, node, Edit("D", row, None))
            if row.fault in ("blank", "duplicate"):
                continue
            if (state, initial) in NEXT:
                self._offer(tips, NEXT[state, initial], cost + more, node, Edit("K", row, row.role))
            role = "a" if state == USER else "u"
            self._offer(tips, NEXT[state, role], cost + RELABEL + more, node, Edit("R", row, NAMES[role]))
        held, self.tips = self.tips, tips
        self._insert()
        self._settle()
        for _, node in held.values():  # only now, since the known order names them
            self._release(node)
        return self._final()

    def _final(self) -> list[Edit]:
        """Edits up to the last ancestor that all survivors share."""
        done = []
        ends = {n for _, n in self.tips.values()}
        while self.uses[self.root] == 1 and self.root not in ends:
            old, self.root = self.root, self.children[self.root]
            done.append(self.edit[self.root])
            self.edit[self.root] = None
            self.free.append(old)
        return done

    def finish(self) -> list[Edit]:
        """The remaining edits; ``cost`` is then that of all."""
        ends = [s for s in ACCEPTED if s in self.tips]
        best = ends[0]
        for state in ends[1:]:
            (cost, node), (least, kept) = self.tips[state], self.tips[best]
            if cost < least or cost == least and self._before(node, kept):
                best = state
        self.cost, node = self.tips.pop(best)
        for _, other in self.tips.values():
            self._release(other)
        self.tips = {best: (self.cost, node)}
        return self._final()


def faulty(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Columns conv_id, turn, role, text and the first fault of each row: blank, duplicate, truncated or none ('').

    A row is blank without any character but white space, a duplicate if its role and text stand in
    an earlier row of the conversation, truncated if its last character but white space ends no
    sentence. The rows of a conversation end up in one partition, sorted. One shuffle.
    """
    rows = turns.select(
        F.col(conversation).alias("conv_id"),
        F.col(turn).cast("bigint").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
    )
    said = Window.partitionBy("conv_id", "role", "text").orderBy("turn")
    bare = F.rtrim(F.col("text"), F.lit(BLANKS))
    return (
        rows.repartition("conv_id")
        .withColumn("said", F.row_number().over(said))
        .select(
            "conv_id",
            "turn",
            "role",
            "text",
            "said",
            F.when(bare == "", "blank")
            .when(F.col("said") > 1, "duplicate")
            .when(~F.substring(bare, -1, 1).isin(".", "!", "?"), "truncated")
            .otherwise("")
            .alias("fault"),
        )
        .sortWithinPartitions("conv_id", "turn", "role", "text", "said")
        .drop("said")
    )


FLUSH_ROWS, FLUSH_CHARS = 4096, 1 << 20
EDIT_FIELDS = "edit string, turn bigint, was string, fault string, role string, text string"
EDIT_TYPES = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()]


def edits(rows: DataFrame) -> DataFrame:
    """The edits that repair each conversation of ``faulty`` rows, those of a conversation together and in order.

    ``edit`` is K, R, D or I; ``turn``, ``was`` (the role before) and ``fault`` are those of the row,
    NULL for inserted ones; ``role`` and ``text`` are what stands there now, NULL for deleted rows;
    ``cost`` stands in the last row of a conversation.
    """
    kind = rows.schema["conv_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[Any] = []
        made: list[tuple] = []
        costs: list[int | None] = []
        chars = 0
        search, last = None, None

        def take(found: list[Edit]) -> None:
            nonlocal chars
            for e in found:
                row = e.row or Turn(None, None, None, None)
                text = None if e.kind == "D" else row.text if e.row else ""
                made.append((e.kind, row.turn, row.role, row.fault, e.role, text))
                ids.append(last)
                costs.append(None)
                chars += len(text or "")

        def end() -> None:
            take(search.finish())
            costs[-1] = search.cost

        def full() -> pa.RecordBatch:
            nonlocal chars
            columns = [pa.array([r[i] for r in made], t) for i, t in enumerate(EDIT_TYPES)]
            out = pa.RecordBatch.from_arrays(
                [pa.array(ids, id_type), *columns, pa.array(costs, pa.int64())],
                ["conv_id", *[f.split()[0] for f in EDIT_FIELDS.split(", ")], "cost"],
            )
            # the last row stays: it may be the end of a conversation, which gets the cost
            ids.clear(), made.clear(), costs.clear()
            chars = 0
            return out

        id_type = None
        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "fault")]
            for conversation, *row in zip(*columns):
                if search is None or conversation != last:
                    if search is not None:
                        end()
                        if len(made) >= FLUSH_ROWS or chars >= FLUSH_CHARS:
                            yield full()
                    search, last = Viterbi(), conversation
                take(search.push(Turn(*row)))
                if len(made) > FLUSH_ROWS or chars > FLUSH_CHARS:
                    kept = (ids.pop(), made.pop(), costs.pop())
                    if made:
                        yield full()
                    ids.append(kept[0]), made.append(kept[1]), costs.append(kept[2])
                    chars = len(kept[1][-1] or "")
        if search is not None:
            end()
            yield full()

    return rows.mapInArrow(run, f"conv_id {kind.simpleString()}, {EDIT_FIELDS}, cost bigint")


def repair(turns: DataFrame, **columns: str) -> DataFrame:
    """Repaired conversations as a table of edits; see ``faulty`` and ``edits``."""
    return edits(faulty(turns, **columns))


def repaired(made: DataFrame) -> DataFrame:
    """The rows of the repaired conversations (conv_id, role, text), in order within a conversation."""
    return made.where(F.col("edit") != "D").select("conv_id", "role", "text")


REPORT_FIELDS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


class Totals:
    """What ``report`` says of one conversation, row by row."""

    def __init__(self) -> None:
        self.turns = self.least = self.most = None
        self.distinct = self.illegal = self.cost = 0
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.initial = None
        self.audit: list[str] = []
        self.digest, self.first = sha256(), True

    def add(self, edit: str, turn: int | None, was: str | None, fault: str | None, role: str | None, text: str | None, cost: int | None) -> None:
        self.audit.append(edit)
        if edit != "I":
            if turn is not None:
                self.distinct += turn != self.most
                self.least, self.most = turn if self.least is None else self.least, turn
            if fault:
                self.faults[fault] += 1
            if self.initial is not None and self.initial + was[:1] not in LEGAL:
                self.illegal += 1
            self.initial = was[:1]
        if edit != "D":
            self.digest.update(f"{'' if self.first else chr(10)}{role}:{text}".encode())
            self.first = False
        if cost is not None:
            self.cost = cost

    def row(self) -> tuple:
        gaps = 0 if self.most is None else self.most - self.least + 1 - self.distinct
        return (gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest())


def report(made: DataFrame) -> DataFrame:
    """One row for each conversation of ``edits``: missing turns, faults, illegal neighbours, cost, audit and digest.

    Reads the edits as they come, without a shuffle. ``audit`` holds the initials of the edits in
    order, ``repaired_sha256`` the digest of role:text, joined by line breaks.
    """
    kind = made.schema["conv_id"].dataType
    names = ["conv_id", *REPORT_FIELDS, "audit", "repaired_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, last, ids, rows, id_type = None, None, [], [], None

        def full() -> pa.RecordBatch:
            columns = [pa.array([r[i] for r in rows], pa.int64() if i < len(REPORT_FIELDS) else pa.string()) for i in range(len(names) - 1)]
            out = pa.RecordBatch.from_arrays([pa.array(ids, id_type), *columns], names)
            ids.clear(), rows.clear()
            return out

        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            columns = [batch.column(c).to_pylist() for c in batch.schema.names]
            for conversation, *row in zip(*columns):
                if totals is None or conversation != last:
                    if totals is not None:
                        ids.append(last), rows.append(totals.row())
                    totals, last = Totals(), conversation
                totals.add(*row)
            if len(rows) >= FLUSH_ROWS:
                yield full()
        if totals is not None:
            ids.append(last), rows.append(totals.row())
            yield full()

    schema = f"conv_id {kind.simpleString()}, " + ", ".join(f"{c} bigint" for c in REPORT_FIELDS) + ", audit string, repaired_sha256 string"
    return made.mapInArrow(run, schema)


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with faults: a checksum of id and turn drops, empties, cuts, repeats or relabels a row.

    NULLs are one space.
    """
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    marked = turns.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        filled("role").alias("role"),
        filled("text").alias("text"),
        (F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn"))) % 20).alias("deal"),
    ).where("deal != 0")
    return marked.select(
        "conv_id",
        "turn",
        F.when(F.col("deal") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("deal") == 1, "")
        .when(F.col("deal") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("deal") == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")
