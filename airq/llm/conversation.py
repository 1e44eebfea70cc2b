"""Conversation structure repair: the cheapest edits that give ``(s?(ua)+)?``, by a persistent audit DP.

A row is kept, given another role or deleted, empty turns are inserted. For each state of the pattern the best audit
so far (a letter per edit) is a linked node; audits share their prefixes. A node has its ancestors at powers of two and a
rolling hash of the letters up to it, so that two audits of equal cost are compared by a search for their
longest common prefix. Equal hashes are verified: equal audits are the same node, others are compared letter by letter.

Rows of a conversation pass through one task in order, because its audit and its checksum are one sequence. The task
holds what is not yet settled: when all live audits share a prefix, its rows are put out and forgotten.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airq.llm.common import WORD_SPACE, byte_slices

KEEP, REROLE, DELETE, INSERT = "KRDI"
RETAG, DROP, ADD, CUT_OFF = 3, 4, 3, 3
# States of the pattern: nothing yet, after s, after u, after a. A conversation may end in the first and the last.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {"s": ((START, SYSTEM),), "u": ((START, USER), (SYSTEM, USER), (ASSISTANT, USER)), "a": ((USER, ASSISTANT),)}
TURNS = NEXT["u"] + NEXT["a"]
# What it costs at most to go on from one state (row) as another one (column) goes on; see ``Repair.settle``.
INSTEAD = ((0, 0, 3, 0), (6, 0, 3, 6), (7, 3, 0, 3), (4, 0, 3, 0))
LEGAL = {"su", "ua", "au"}
NEVER = 1 << 60
# Rows and characters of text after which a conversation is settled as far as possible.
SETTLE_ROWS, SETTLE_CHARS = 1024, 2_000_000
PRIME, BASE = (1 << 61) - 1, 1_000_003


class Node:
    """An audit: its last letter, its length, its hash, and its ancestors 1, 2, 4, ... letters up."""

    __slots__ = ("letter", "depth", "hash", "up")

    def __init__(self, parent: Node | None, letter: str):
        self.letter = letter
        if parent is None:
            self.depth, self.hash, self.up = 0, 0, []
            return
        self.depth = parent.depth + 1
        self.hash = (parent.hash * BASE + ord(letter)) % PRIME
        self.up = up = [parent]
        k = 0
        while k < len(up[k].up):
            up.append(up[k].up[k])
            k += 1


def ancestor(node: Node, depth: int) -> Node:
    while node.depth > depth:
        node = node.up[(node.depth - depth).bit_length() - 1]
    return node


def letters(node: Node, above: Node | None = None) -> str:
    """The audit of ``node``, or what it has behind that of its ancestor ``above``."""
    out = []
    while node is not above and node.up:
        out.append(node.letter)
        node = node.up[0]
    return "".join(reversed(out))


def verified(a: Node, b: Node) -> bool:
    """Whether two audits of one length are equal, letter by letter down to the node they share."""
    while a is not b:
        if a.letter != b.letter:
            return False
        a, b = a.up[0], b.up[0]
    return True


def before(a: Node, b: Node) -> bool:
    """Whether audit ``a`` is less than ``b`` in ASCII order, by a search for their longest common prefix."""
    short = min(a.depth, b.depth)
    x, y = ancestor(a, short), ancestor(b, short)
    if x is y or x.hash == y.hash:
        return a.depth < b.depth if verified(x, y) else letters(a) < letters(b)
    for k in range(len(x.up) - 1, -1, -1):
        if k < len(x.up) and x.up[k] is not y.up[k] and x.up[k].hash != y.up[k].hash:
            x, y = x.up[k], y.up[k]
    return x.letter < y.letter if verified(x.up[0], y.up[0]) else letters(a) < letters(b)


@dataclass
class Summary:
    """What one conversation had and what its repair costs."""

    gaps: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    cost: int = 0
    audit: str = ""
    repaired_sha256: str = ""


@dataclass
class Repair:
    """The rows of one conversation in order, by ``add``; ``emit`` gets every repaired message once it is settled."""

    emit: Callable[[str, int | None, str, str], None]
    found: Summary = field(default_factory=Summary)

    def __post_init__(self) -> None:
        self.root = Node(None, "")
        self.cost = [0, NEVER, NEVER, NEVER]
        self.node: list[Node | None] = [self.root, None, None, None]
        self.rows: list[tuple] = []
        self.chars = 0
        self.seen: set[bytes] = set()
        self.last_initial: str | None = None
        self.turns: list[int] = []
        self.distinct = 0
        self.state, self.audit, self.messages = START, [], 0
        self.sha = hashlib.sha256()
        self._insert(self.cost, self.node)

    def add(self, turn: int | None, role: str, text: str) -> None:
        initial, ending = role[:1], text.rstrip(WORD_SPACE)[-1:]
        if self.last_initial is not None:
            self.found.illegal += self.last_initial + initial not in LEGAL
        self.last_initial = initial
        if turn is not None and (not self.turns or turn != self.turns[1]):
            self.turns = [self.turns[0] if self.turns else turn, turn]
            self.distinct += 1
        digest = hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()
        again = digest in self.seen
        self.seen.add(digest)
        cut = 0
        if not ending:
            self.found.blank += 1
        elif again:
            self.found.duplicate += 1
        elif ending not in ".!?":
            self.found.truncated += 1
            cut = CUT_OFF
        self._step(initial, not ending or again, cut)
        self.rows.append((turn, role, text))
        self.chars += len(text)
        if len(self.rows) >= SETTLE_ROWS or self.chars >= SETTLE_CHARS:
            self.settle()

    def _step(self, initial: str, must_go: bool, cut: int) -> None:
        was, audit = self.cost, self.node
        cost, node = [NEVER] * 4, [None] * 4
        offers = [(q, q, DROP, DELETE) for q in range(4)]
        if not must_go:
            offers += [(p, q, cut, KEEP) for p, q in NEXT.get(initial, ())]
            offers += [(p, q, cut + RETAG, REROLE) for p, q in TURNS]
        for p, q, price, letter in offers:
            if audit[p] is not None:
                self._offer(cost, node, q, was[p] + price, audit[p], letter)
        self._insert(cost, node)
        self.cost, self.node = cost, node

    def _insert(self, cost: list[int], node: list[Node | None]) -> None:
        """Empty turns behind the last row; two of them are enough, a third would undo the first's change of state."""
        offers = [(cost[p], node[p]) for p in (START, SYSTEM, ASSISTANT) if node[p] is not None]
        for price, parent in offers:
            self._offer(cost, node, USER, price + ADD, parent, INSERT)
        if node[USER] is not None:
            self._offer(cost, node, ASSISTANT, cost[USER] + ADD, node[USER], INSERT)

    @staticmethod
    def _offer(cost: list[int], node: list[Node | None], state: int, price: int, parent: Node, letter: str) -> None:
        """Of two audits of one state and cost none is the start of the other: what is longer has more inserts."""
        if price < cost[state]:
            cost[state], node[state] = price, Node(parent, letter)
        elif price == cost[state] and before(other := Node(parent, letter), node[state]):
            node[state] = other

    def settle(self) -> None:
        """Put out what all audits that may still win have in common, and start the audits behind it.

        A state is out if another one can go on as it does for less in all.
        """
        for q in range(4):
            if any(self.cost[p] + INSTEAD[p][q] < self.cost[q] for p in range(4)):
                self.cost[q], self.node[q] = NEVER, None
        live = [n for n in self.node if n is not None]
        common = live[0]
        for n in live[1:]:
            depth = min(common.depth, n.depth)
            common, n = ancestor(common, depth), ancestor(n, depth)
            while common is not n:
                common, n = common.up[0], n.up[0]
        self._put_out(letters(common))
        self.root = Node(None, "")
        moved = {id(common): self.root}
        for n in live:
            chain = []
            while id(n) not in moved:
                chain.append(n)
                n = n.up[0]
            for n in reversed(chain):
                moved[id(n)] = Node(moved[id(n.up[0])], n.letter)
        self.node = [None if n is None else moved[id(n)] for n in self.node]

    def _put_out(self, edits: str) -> None:
        at = 0
        for edit in edits:
            turn, role, text = (None, "", "") if edit == INSERT else self.rows[at]
            at += edit != INSERT
            if edit == DELETE:
                continue
            if edit != KEEP:
                role = "assistant" if self.state == USER else "user"
            self.state = dict(NEXT[role[:1]])[self.state]
            if self.messages:
                self.sha.update(b"\n")
            self.sha.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
            self.emit(edit, turn, role, text)
            self.messages += 1
        self.audit.append(edits)
        self.chars -= sum(len(r[2]) for r in self.rows[:at])
        del self.rows[:at]

    def finish(self) -> Summary:
        first, last = (self.node[q] if self.cost[q] < NEVER else None for q in (START, ASSISTANT))
        pick = ASSISTANT
        if last is None or first is not None and (
            self.cost[START] < self.cost[ASSISTANT] or self.cost[START] == self.cost[ASSISTANT] and before(first, last)
        ):
            pick = START
        self._put_out(letters(self.node[pick]))
        self.found.cost = self.cost[pick]
        self.found.audit = "".join(self.audit)
        self.found.repaired_sha256 = self.sha.hexdigest()
        if self.turns:
            self.found.gaps = self.turns[1] - self.turns[0] + 1 - self.distinct
        return self.found


NUMBERS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
SUMMARY = [*NUMBERS, "audit", "repaired_sha256"]
MESSAGE = ["position", "edit", "turn", "role", "text"]


def _walk(batches: Iterator[pa.RecordBatch], messages: bool) -> Iterator[tuple[list, list]]:
    """Ids and results of the conversations of a sorted partition, a list for each bounded slice of it."""
    ids: list = []
    results: list = []
    key, repair = None, None

    def emitter(conversation) -> Callable[[str, int | None, str, str], None]:
        count = [0]

        def emit(edit: str, turn: int | None, role: str, text: str) -> None:
            if messages:
                ids.append(conversation)
                results.append((count[0], edit, turn, role, text))
                count[0] += 1

        return emit

    def close() -> None:
        found = repair.finish()
        if not messages:
            ids.append(key)
            results.append(tuple(getattr(found, c) for c in SUMMARY))

    for batch in batches:
        for part in byte_slices(batch, "_text"):
            for conversation, there, turn, role, text in zip(*(c.to_pylist() for c in part.columns)):
                if repair is None or conversation != key and not (conversation != conversation and key != key):
                    if repair is not None:
                        close()
                    key, repair = conversation, Repair(emitter(conversation))
                if there:
                    repair.add(turn, " " if role is None else role, " " if text is None else text)
            if ids:
                yield ids, results
                ids.clear()
                results.clear()
    if repair is not None:
        close()
    if ids:
        yield ids, results


def _in_order(rows: DataFrame, id_column: str, present: Column | None) -> DataFrame:
    kept = rows.select(
        F.col(id_column).alias("_id"),
        F.coalesce(F.lit(True) if present is None else present, F.lit(False)).alias("_there"),
        F.col("turn").cast("long").alias("_turn"),
        F.col("role").alias("_role"),
        F.col("text").alias("_text"),
    )
    return kept.repartition("_id").sortWithinPartitions("_id", F.col("_turn").asc_nulls_first(), "_role", "_text")


def audit_conversations(rows: DataFrame, present: Column | None = None, id_column: str = "conv_id") -> DataFrame:
    """One row per conversation: its faults, the cost and the edits of its repair, and a checksum of the repaired text.

    ``rows`` has ``turn``, ``role``, ``text`` and the id. Rows are taken by turn (null first), then role, then text; a null
    role or text is one space, a null id is a conversation too. A row where ``present`` does not hold only names its
    conversation. ``gaps`` are the turns missing between the first and the last. A row's first fault counts: ``blank``
    (no character but white space), ``duplicate`` (role and text as in an earlier row), ``truncated`` (does not end in
    ``.``, ``!`` or ``?``). ``illegal`` counts neighbours whose roles' first letters do not follow each other. ``audit``
    has a letter per edit (Keep, Rerole, Delete, Insert), of the cheapest audits the least. A row without a role can be
    re-roled or deleted, not kept. ``repaired_sha256`` is that of the repaired ``role:text``, joined by newlines; of nothing
    without a message. An empty table gives no rows.

    A task holds 16 bytes for each distinct row of the conversation it reads, and its rows from the last settled one on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, results in _walk(batches, messages=False):
            columns = list(zip(*results))
            arrays = [pa.array(ids, kind), *(pa.array(c, pa.int64()) for c in columns[:6]), *(pa.array(c) for c in columns[6:])]
            yield pa.RecordBatch.from_arrays(arrays, ["_id", *SUMMARY])

    ordered = _in_order(rows, id_column, present)
    kind = _arrow_type(ordered)
    schema = f"_id {ordered.schema['_id'].dataType.simpleString()}, " + ", ".join(f"{c} long" for c in NUMBERS)
    found = ordered.mapInArrow(run, f"{schema}, audit string, repaired_sha256 string")
    return found.withColumnRenamed("_id", id_column)


def repaired_messages(rows: DataFrame, present: Column | None = None, id_column: str = "conv_id") -> DataFrame:
    """The messages behind ``audit_conversations``: id, ``position`` (from 0), ``edit``, ``turn`` (null if inserted), ``role``, ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, results in _walk(batches, messages=True):
            columns = list(zip(*results))
            types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]
            arrays = [pa.array(ids, kind), *(pa.array(c, t) for c, t in zip(columns, types))]
            yield pa.RecordBatch.from_arrays(arrays, ["_id", *MESSAGE])

    ordered = _in_order(rows, id_column, present)
    kind = _arrow_type(ordered)
    schema = f"_id {ordered.schema['_id'].dataType.simpleString()}, position long, edit string, turn long, role string, text string"
    return ordered.mapInArrow(run, schema).withColumnRenamed("_id", id_column)


def _arrow_type(ordered: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(ordered.schema["_id"].dataType)
