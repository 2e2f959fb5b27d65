"""Conversations made well-formed by the cheapest edits, found as their turns stream by.

A conversation is well-formed if the first letters of its roles read
`(s?(ua)+)?`: perhaps a system turn, then user and assistant in turn. A turn
may be kept (K, free) where its role fits, given the role that fits (R, 1) or
deleted (D, 2), and empty user or assistant turns may be put in anywhere (I, 5
each). Blank and repeated turns must be deleted; a truncated turn that stays
costs 5 more. Of equally cheap edits the least string of letters is taken.

The edits are a path through four states (nothing yet, after s, after u, after
a). Per turn, one survivor reaches each state. Survivors are leaves of a tree
of backpointers whose nodes count their references; a node without any goes,
and as soon as all survivors share a first edit, it is emitted and the root
moves on. So the tree holds only what is unresolved. A survivor that must cost
more than another one, whatever follows, is dropped, or it would hold up the others. Equal costs are decided
by the complete unresolved suffixes: survivors carry their rank in that order,
and the order of two extensions follows from the ranks and the new letters, so
no suffix is read again. Each survivor carries the running digest of its
repaired turns, so no text is kept.

One conversation is one task's stream, since the digest of a text has no
parallel form; rows reach it in sorted order by Spark's external sort, and
memory is a letter per edit (the result) and the unresolved part of the tree.
Whether a turn repeats an earlier one is found before, by a shuffle of digests
alone, so no task remembers a conversation's turns.

Turns are in the order of their number, nulls first, then role and text; a null
role or text is one space. A role without s, u or a in front can't be kept. A
null conversation id is a conversation of its own. Repeated rows are repeated
turns. A conversation without turns has counts of 0 and no edits, and an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cmp_to_key

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clusterprep.llm.rows import map_arrow, picked, small
from clusterprep.session import cut_lineage

REROLE, DELETE, INSERT, CUT_SHORT = 1, 2, 5, 5
SPACES = " \t\n\x0b\x0c\r"
ENDINGS = ".!?"
ROWS = 1000  # results sent together

SOUND, BLANK, TRUNCATED, REPEATED = 0, 1, 2, 3
_NOTHING, _SYSTEM, _USER, _ASSISTANT = range(4)
# The state that a role of this letter leads to, by state.
_NEXT = [{"s": _SYSTEM, "u": _USER}, {"u": _USER}, {"a": _ASSISTANT}, {"u": _USER}]
_ROLE = {_USER: "user", _ASSISTANT: "assistant"}
_LEGAL = frozenset(("su", "ua", "au"))
_MOST = 2**63 - 1


class Node:
    """An edit after those of its parent."""

    __slots__ = ("parent", "edit", "level", "rank", "children", "held", "turn")

    def __init__(self, parent: Node | None, edit: str, level: int, turn: tuple[str, str] | None):
        self.parent, self.edit, self.level, self.turn = parent, edit, level, turn
        self.rank = 0
        self.held = False  # by a survivor
        self.children: set[Node] = set()
        if parent is not None:
            parent.children.add(self)

    def release(self) -> None:
        """Cut off this node and all above it that nothing refers to."""
        node = self
        while node.parent is not None and not node.held and not node.children:
            parent, node.parent = node.parent, None
            parent.children.discard(node)
            node = parent


def _last_letters(node: Node) -> tuple[str, Node | None]:
    """The edits of a node's own level, and the survivor of the level before."""
    letters, level = node.edit, node.level
    up = node.parent
    while up is not None and up.level == level:
        letters, up = up.edit + letters, up.parent
    return letters, up


def _extends(node: Node, other: Node) -> int:
    """By how many inserted turns of its level a node extends another; 0 if it doesn't."""
    count = 0
    while node is not other:
        if node.edit != "I" or node.parent is None or node.parent.level != other.level:
            return 0
        node, count = node.parent, count + 1
    return count


def compare(x: Node, y: Node) -> int:
    """Order of the edits up to two nodes of one level, as strings."""
    if x is y:
        return 0
    left, a = _last_letters(x)
    right, b = _last_letters(y)
    if a is not b:
        # Survivors differ before their ends, unless one is the other and inserted turns.
        if count := _extends(b, a):
            right = "I" * count + right
        elif count := _extends(a, b):
            left = "I" * count + left
        else:
            return a.rank - b.rank
    return (left > right) - (left < right)


class Repair:
    """Cheapest edits of one conversation, turn by turn.

    `emit` is called with (edit, turn) as edits are resolved, where turn is the
    (role, text) that the edit leaves (None after D). Without it, letters are
    kept for `finish` and turns go into digests only.
    """

    def __init__(self, emit: Callable[[str, tuple[str, str] | None], None] | None = None):
        self._emit = emit
        self._letters: list[str] = []
        self._root = Node(None, "", 0, None)
        self._level = 0
        self._survivors = {_NOTHING: (0, self._root)}
        self._digests = {self._root: (None if emit else hashlib.sha256(), False)}
        self._insert()

    def push(self, role: str, text: str, fault: int) -> None:
        """Add the next turn."""
        before, self._level = self._survivors, self._level + 1
        best: dict[int, tuple[int, Node, str, str]] = {}
        extra = CUT_SHORT if fault == TRUNCATED else 0
        for state, (cost, node) in before.items():
            self._offer(best, state, cost + DELETE, node, "D", role)
            if fault in (BLANK, REPEATED):
                continue
            for letter, after in _NEXT[state].items():
                if role[:1] == letter:
                    self._offer(best, after, cost + extra, node, "K", role)
                elif after in _ROLE:
                    self._offer(best, after, cost + extra + REROLE, node, "R", _ROLE[after])
        self._survivors = {}
        for state, (cost, node, edit, as_role) in best.items():
            turn = None if edit == "D" else (as_role, text)
            self._survivors[state] = (cost, self._grow(node, edit, turn))
        self._insert()
        for _, node in before.values():
            self._drop(node)
        self._resolve()

    def _offer(self, best, state, cost, node, edit, role) -> None:
        known = best.get(state)
        if known is None or cost < known[0] or cost == known[0] and self._before(node, edit, known):
            best[state] = (cost, node, edit, role)

    @staticmethod
    def _before(node: Node, edit: str, known) -> bool:
        """Whether node and edit come before the known choice as strings."""
        _, other, letter, _ = known
        if count := _extends(other, node):
            return edit < "I" * count + letter
        if count := _extends(node, other):
            return "I" * count + edit < letter
        return node.rank < other.rank if node is not other else edit < letter

    def _insert(self) -> None:
        """Extend survivors by inserted turns while that is cheaper, drop hopeless ones, rank the rest."""
        survivors = self._survivors
        changed = True
        while changed:
            changed = False
            for state in list(survivors):
                cost, node = survivors[state]
                after = _USER if _USER in _NEXT[state].values() else _ASSISTANT
                known = survivors.get(after)
                if known and known[0] < cost + INSERT:
                    continue
                if known and known[1].parent is node and known[1].edit == "I":
                    continue
                new = self._grow(node, "I", (_ROLE[after], ""))
                if known and known[0] == cost + INSERT and compare(new, known[1]) >= 0:
                    self._drop(new)
                    continue
                survivors[after] = (cost + INSERT, new)
                if known:
                    self._drop(known[1])
                changed = True
        # What can follow nothing or a system turn can follow an assistant turn,
        # but for the system turn itself, which then has to be deleted.
        done = survivors[_ASSISTANT][0]
        for state, extra in ((_NOTHING, DELETE), (_SYSTEM, 0)):
            if state in survivors and survivors[state][0] > done + extra:
                self._drop(survivors.pop(state)[1])
        order = sorted((node for _, node in survivors.values()), key=cmp_to_key(compare))
        for rank, node in enumerate(order):
            node.rank = rank

    def _drop(self, node: Node) -> None:
        node.held = False
        self._digests.pop(node, None)
        node.release()

    def _grow(self, parent: Node, edit: str, turn: tuple[str, str] | None) -> Node:
        node = Node(parent, edit, self._level, turn if self._emit else None)
        node.held = True
        digest, some = self._digests[parent]
        if turn is not None and digest is not None:
            digest = digest.copy()
            digest.update((("\n" if some else "") + f"{turn[0]}:{turn[1]}").encode())
        self._digests[node] = (digest, some or turn is not None)
        return node

    def _resolve(self) -> None:
        """Emit the edits that all survivors share."""
        while len(self._root.children) == 1 and not self._is_survivor(self._root):
            (child,) = self._root.children
            self._root.children = set()
            child.parent = None
            self._root = child
            self._send(child)

    def _is_survivor(self, node: Node) -> bool:
        return any(node is other for _, other in self._survivors.values())

    def _send(self, node: Node) -> None:
        if self._emit:
            self._emit(node.edit, node.turn)
        else:
            self._letters.append(node.edit)

    def unresolved(self) -> int:
        """Nodes of the tree below its root."""
        nodes, waiting = 0, list(self._root.children)
        while waiting:
            node = waiting.pop()
            nodes += 1
            waiting.extend(node.children)
        return nodes

    def finish(self) -> tuple[int, str, str]:
        """Cost, letters and digest of the best whole path; with `emit`, only the cost counts."""
        ends = [self._survivors[s] for s in (_NOTHING, _ASSISTANT) if s in self._survivors]
        least = min(cost for cost, _ in ends)
        node = min((n for cost, n in ends if cost == least), key=cmp_to_key(compare))
        digest = self._digests[node][0]
        path = []
        while node is not self._root:
            path.append(node)
            node = node.parent
        for node in reversed(path):
            self._send(node)
        return least, "".join(self._letters), digest.hexdigest() if digest else ""


def fault_of(text: Column) -> Column:
    """BLANK, TRUNCATED (its last sign ends no sentence) or SOUND."""
    bare = F.rtrim(text, F.lit(SPACES))
    last = F.right(bare, F.lit(1))
    blank, cut = bare == "", ~last.isin(*ENDINGS)
    return F.when(blank, BLANK).when(cut, TRUNCATED).otherwise(SOUND)


def _streams(
    conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, present_col: str | None
) -> DataFrame:
    """Turns with their fault, each conversation in one partition and in order."""
    columns = {"conv_id": conv_col, "turn": turn_col, "role": role_col, "text": text_col}
    rows = picked(conversations, **columns | ({"present": present_col} if present_col else {}))
    present = F.coalesce("present", F.lit(False)) if present_col else F.lit(True)
    rows = rows.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(present, F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(present, F.coalesce("text", F.lit(" "))).alias("text"),
    )
    same = F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256)
    turns = rows.withColumn("same", F.when(F.col("role").isNotNull(), same))
    # Nulls are turns before all numbers; a group's first turn is its least.
    first = F.min(F.struct(F.col("turn").isNotNull().alias("numbered"), "turn"))
    repeated = (
        turns.filter(F.col("same").isNotNull())
        .groupBy("conv_id", "same")
        .agg(first.alias("first"), F.count(F.lit(1)).alias("times"))
        .filter("times > 1")
        .select(F.col("conv_id").alias("c"), F.col("same").alias("s"), "first")
    )
    repeated = cut_lineage(repeated, "repeated")
    both = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("same") == F.col("s"))
    marked = turns.join(small(repeated), both, "left").select(
        "conv_id",
        "turn",
        "role",
        "text",
        fault_of(F.col("text")).alias("fault"),
        F.col("first").isNotNull().alias("shared"),
        (F.struct(F.col("turn").isNotNull().alias("numbered"), "turn") > F.col("first")).alias("later"),
    )
    return marked.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def _conversations(batches) -> Iterator[tuple[object, Iterator[tuple]]]:
    """Each conversation's id and its rows; the rows must be read before the next one."""

    def rows():
        for batch in batches:
            yield from zip(*[column.to_pylist() for column in batch.columns])

    stream = rows()
    row = next(stream, None)
    while row is not None:
        conv = row[0]

        def own():
            nonlocal row
            while row is not None and (row[0] == conv or (row[0] != row[0] and conv != conv)):
                current = row
                row = next(stream, None)
                yield current

        yield conv, own()


def _faults(rows: Iterator[tuple]) -> Iterator[tuple[int | None, str, str, int]]:
    """Turn number, role, text and fault of the rows that are present."""
    previous = None
    for _, turn, role, text, fault, shared, later in rows:
        if role is None:
            continue
        if fault != BLANK and shared and (later or previous == (turn, role, text)):
            fault = REPEATED
        previous = (turn, role, text) if shared else None
        yield turn, role, text, fault


def _summary(rows: Iterator[tuple]) -> tuple:
    counts = {BLANK: 0, REPEATED: 0, TRUNCATED: 0}
    least = most = initial = None
    numbers = illegal = 0
    repair = Repair()
    for turn, role, text, fault in _faults(rows):
        if fault:
            counts[fault] += 1
        if turn is not None and turn != most:
            numbers += 1
            least, most = turn if least is None else least, turn
        if initial is not None and initial + role[:1] not in _LEGAL:
            illegal += 1
        initial = role[:1]
        repair.push(role, text, fault)
    gaps = 0 if least is None else min(most - least + 1 - numbers, _MOST)
    return gaps, counts[BLANK], counts[REPEATED], counts[TRUNCATED], illegal, *repair.finish()


def repair_conversations(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    present_col: str | None = None,
) -> DataFrame:
    """One row per conversation: its faults, and its cheapest edits.

    gaps (missing turn numbers; the largest long if there are more), blank,
    duplicate and truncated turns by their first fault, illegal (neighbours
    whose roles can't follow each other), cost, audit (the edits' letters), and
    the SHA-256 of the repaired `role:text` turns joined by line feeds. Rows
    whose `present_col` is not true only say that their conversation exists.
    """
    rows = _streams(conversations, conv_col, turn_col, role_col, text_col, present_col)
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    texts = ["audit", "repaired_sha256"]
    types = [pa.int64()] * len(numbers) + [pa.string()] * len(texts)

    def run(batches):
        kind = None

        def typed(stream):
            nonlocal kind
            for batch in stream:
                kind = batch.column(0).type
                yield batch

        def sent(done):
            ids, found = zip(*done)
            columns = [pa.array(c, t) for c, t in zip(zip(*found), types)]
            return pa.RecordBatch.from_arrays([pa.array(ids, kind), *columns], ["conv_id", *numbers, *texts])

        done = []
        for conv, own in _conversations(typed(batches)):
            done.append((conv, _summary(own)))
            if len(done) == ROWS:
                yield sent(done)
                done = []
        if done:
            yield sent(done)

    schema = [T.StructField(n, T.LongType()) for n in numbers] + [T.StructField(n, T.StringType()) for n in texts]
    return map_arrow(rows, run, T.StructType([rows.schema["conv_id"], *schema]))


def repaired_turns(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """The turns of the repaired conversations: conv_id, turn (from 0), role, text, edit (K, R or I).

    Texts are kept only while their edits are unresolved.
    """
    rows = _streams(conversations, conv_col, turn_col, role_col, text_col, None)

    fields = T.StructType.fromDDL("turn long, role string, text string, edit string").fields
    return map_arrow(rows, _turn_batches, T.StructType([rows.schema["conv_id"], *fields]))


def _turn_batches(batches) -> Iterator[pa.RecordBatch]:
    kind = None

    def typed():
        nonlocal kind
        for batch in batches:
            kind = batch.column(0).type
            yield batch

    out: list[tuple] = []

    def sent():
        ids, turns, roles, texts, edits = zip(*out)
        out.clear()
        columns = [pa.array(ids, kind), pa.array(turns, pa.int64()), *map(pa.array, (roles, texts, edits))]
        return pa.RecordBatch.from_arrays(columns, ["conv_id", "turn", "role", "text", "edit"])

    for conv, own in _conversations(typed()):
        number = 0

        def emit(edit, turn):
            nonlocal number
            if turn is not None:
                out.append((conv, number, *turn, edit))
                number += 1

        repair = Repair(emit)
        for _, role, text, fault in _faults(own):
            repair.push(role, text, fault)
            if len(out) >= ROWS:
                yield sent()
        repair.finish()
    if out:
        yield sent()
