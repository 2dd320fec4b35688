"""Repair of a conversation's structure: a Viterbi search whose survivors emit their edits once they share an ancestor.

Turns stream through in order. For each state of the role pattern ``(s?(ua)+)?`` the cheapest way to reach it survives, with
the ASCII-least edits among equally cheap ones, as a node of a tree of backpointers. Nodes count what refers to them:
those that no survivor can reach go at once, and where the root has a single way down, all survivors agree on it, so its edits
are emitted and the root moves down. What is held is the part on which survivors still differ.

Two ways to the same state after the same turns that cost the same are never one the start of the other, since a further
edit on top would cost more. So comparing their edits from the root on decides for every continuation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliovane.llm.common import stored

REROLE, DELETE, INSERT, UNFINISHED = 3, 4, 3, 3

#: Conversations of one result batch.
BATCH = 1_000

# Nothing yet, after the system's turn, after the user's, after the assistant's. The first and the last may be the end.
_NONE, _SYSTEM, _USER, _ASSISTANT = range(4)
_BEFORE_USER = (_NONE, _SYSTEM, _ASSISTANT)
_LEGAL = ("su", "ua", "au")

_NUMBERS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_TEXTS = ("audit", "repaired_sha256")


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with faults, by ``crc32(conv_id:turn) % 20``; nulls stand as one space.

    0 drops the turn, 1 empties its text, 2 removes its full stops, exclamation and question marks, 3 repeats it, 4 makes the
    user say it.
    """

    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(shown("text"), "[.!?]", "")).otherwise(shown("text"))
    copies = F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    role = F.when(kind == 4, "user").otherwise(shown("role"))
    rows = conversations.where(kind != 0)
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


class _Node:
    """An edit that some survivor has made, after those of its parents. ``line`` is the turn it leaves, if any."""

    __slots__ = ("parent", "letter", "line", "refs")

    def __init__(self, parent: _Node | None, letter: str, line: str | None) -> None:
        self.parent, self.letter, self.line, self.refs = parent, letter, line, 0
        if parent is not None:
            parent.refs += 1


def _released(node: _Node | None) -> None:
    """One reference less; a node without any goes, and with it its reference to its parent."""
    while node is not None:
        node.refs -= 1
        if node.refs or node.parent is None:
            return
        node.parent, node = None, node.parent


class Repair:
    """The search over one conversation. ``held`` is the number of edits not emitted yet on the longest way."""

    def __init__(self) -> None:
        self.root = _Node(None, "", None)
        self.root.refs = 1
        self.best: list[tuple[int, _Node] | None] = [(0, self.root), None, None, None]
        self.audit: list[str] = []
        self.digest = hashlib.sha256()
        self.lines = 0
        self._close()

    def _suffix(self, node: _Node) -> str:
        letters = []
        while node is not self.root:
            letters.append(node.letter)
            node = node.parent
        return "".join(reversed(letters))

    def _least(self, ways: list[tuple[int, _Node, str, str | None]]) -> tuple[int, _Node, str, str | None]:
        """The cheapest of several ``cost, parent, letter, line``; among those the ASCII-least from the root on."""
        cost = min(way[0] for way in ways)
        ways = [way for way in ways if way[0] == cost]
        if len(ways) == 1:
            return ways[0]
        return min(ways, key=lambda way: self._suffix(way[1]) + way[2])

    def _close(self) -> None:
        """Turns put in after the last one: the user's after any but the user's own, then the assistant's."""
        for state, sources, line in ((_USER, _BEFORE_USER, "user:"), (_ASSISTANT, (_USER,), "assistant:")):
            ways = [(self.best[s][0] + INSERT, self.best[s][1], "I", line) for s in sources if self.best[s]]
            own = self.best[state]
            if own is not None:
                ways.append((*own, "", None))
            if not ways:
                continue
            cost, parent, letter, line = self._least(ways)
            if letter:
                node = _Node(parent, letter, line)
                node.refs = 1
                self.best[state] = (cost, node)
                if own is not None:
                    _released(own[1])

    def turn(self, initial: str, role: str, text: str, must_go: bool, unfinished: bool) -> None:
        ways: list[list] = [[] for _ in self.best]
        for state, held in enumerate(self.best):
            if held is not None:
                ways[state].append((held[0] + DELETE, held[1], "D", None))
        if not must_go:
            extra = UNFINISHED if unfinished else 0
            moves = [(s, _USER, "u", "user") for s in _BEFORE_USER]
            moves += [(_USER, _ASSISTANT, "a", "assistant"), (_NONE, _SYSTEM, "s", None)]
            for source, target, needed, named in moves:
                if (held := self.best[source]) is None:
                    continue
                if initial == needed:
                    ways[target].append((held[0] + extra, held[1], "K", f"{role}:{text}"))
                elif named is not None:
                    ways[target].append((held[0] + extra + REROLE, held[1], "R", f"{named}:{text}"))
        old, new = self.best, []
        for choices in ways:
            if choices:
                cost, parent, letter, line = self._least(choices)
                new.append((cost, _Node(parent, letter, line)))
                new[-1][1].refs = 1
            else:
                new.append(None)
        self.best = new
        for held in old:
            if held is not None:
                _released(held[1])
        self._close()
        self._prune()
        if self.root.refs == 1:
            self._emit()

    def _prune(self) -> None:
        """Survivors go that can end neither cheaper than the assistant's state nor as cheap.

        Whatever follows the system's turn may follow the assistant's at the same cost, and so may what follows no turn at
        all, but for a system's turn to keep, which can be deleted instead.
        """
        best = self.best[_ASSISTANT]
        if best is None:
            return
        for state, more in ((_SYSTEM, 0), (_NONE, DELETE)):
            held = self.best[state]
            if held is not None and best[0] + more < held[0]:
                self.best[state] = None
                _released(held[1])

    def _written(self, node: _Node) -> None:
        self.audit.append(node.letter)
        if node.line is not None:
            self.digest.update(("\n" if self.lines else "").encode() + node.line.encode("utf-8", "surrogatepass"))
            self.lines += 1

    def _emit(self) -> None:
        """What all survivors share below the root."""
        node = next(held[1] for held in self.best if held is not None)
        way = []
        while node is not self.root:
            way.append(node)
            node = node.parent
        while way and self.root.refs == 1:
            self.root = way.pop()
            self.root.parent = None
            self._written(self.root)
            self.root.line = None

    @property
    def held(self) -> int:
        return max(len(self._suffix(held[1])) for held in self.best if held is not None)

    def ended(self) -> tuple[int, str, str]:
        """The cost, the edits' letters, and the digest of what is left."""
        ways = [(*self.best[s], "", None) for s in (_NONE, _ASSISTANT) if self.best[s] is not None]
        cost, node, _, _ = self._least(ways)
        way = []
        while node is not self.root:
            way.append(node)
            node = node.parent
        for node in reversed(way):
            self._written(node)
        return cost, "".join(self.audit), self.digest.hexdigest()


class _Conversation:
    """What is counted of one conversation besides its repair."""

    def __init__(self) -> None:
        self.repair = Repair()
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal, self.initial = 0, None
        self.turns, self.first, self.last = 0, None, None

    def add(self, turn: int | None, role: str, text: str, fault: str | None) -> None:
        if turn is not None and turn != self.last:
            self.turns += 1
            self.first, self.last = turn if self.first is None else self.first, turn
        if fault is not None:
            self.counts[fault] += 1
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in _LEGAL:
            self.illegal += 1
        self.initial = initial
        self.repair.turn(initial, role, text, fault in ("blank", "duplicate"), fault == "truncated")

    def row(self) -> tuple:
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return gaps, *self.counts.values(), self.illegal, *self.repair.ended()


def _reported(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    types = [id_type, *[pa.int64()] * len(_NUMBERS), *[pa.string()] * len(_TEXTS)]
    arrays = [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=["conv_id", *_NUMBERS, *_TEXTS])


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted turns, one conversation after the other."""
    done: list[tuple] = []
    current = conversation = id_type = None
    for batch in batches:
        id_type = batch.column(0).type
        for conv_id, present, *turn in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if conversation is None or conv_id != current:
                if conversation is not None:
                    done.append((current, *conversation.row()))
                current, conversation = conv_id, _Conversation()
            if len(done) >= BATCH:
                yield _reported(done, id_type)
                done = []
            if present:
                conversation.add(*turn)
    if conversation is not None:
        yield _reported([*done, (current, *conversation.row())], id_type)


def _faults(rows: DataFrame) -> DataFrame:
    """``rows`` with ``fault``: the first of blank, duplicate, truncated that a turn has."""
    visible = r"[^\x20\x09-\x0D]"
    same = F.sha2(
        F.concat_ws(
            ":", F.coalesce(F.concat(F.lit("="), "conv_id"), F.lit("")), F.length("role"), "role", "text"
        ),
        256,
    )
    # A place of its own tells equal turns apart; what is stored keeps it in a task that runs again.
    rows = rows.select("*", F.monotonically_increasing_id().alias("place"), F.unhex(same).alias("same"))
    rows = stored(rows, "conversation-turns")
    repeated = rows.groupBy("same").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("turn", "place")).alias("first"))
    repeated = repeated.where("n > 1").select("same", F.col("first.place").alias("first_place"))
    rows = rows.join(repeated, "same", "left")
    ending = F.regexp_extract("text", rf"(?s)({visible})[\x20\x09-\x0D]*$", 1)
    fault = (
        F.when(ending == "", "blank")
        .when(F.col("place") != F.col("first_place"), "duplicate")
        .when(~ending.isin(".", "!", "?"), "truncated")
    )
    return rows.select("conv_id", "turn", "role", "text", "place", fault.alias("fault"))


def repaired_conversations(turns: DataFrame, every: DataFrame | None = None) -> DataFrame:
    """One row per conversation: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.

    ``turns`` has ``conv_id, turn, role, text``, taken by turn, null turns first, turns of the same number by role and text. A
    turn's first fault counts: blank (nothing but white space), duplicate (role and text seen earlier), truncated (no full
    stop, exclamation or question mark at its end). ``illegal`` counts neighbours whose roles may not follow one another,
    ``gaps`` the numbers missing between the first and the last turn. Edits: K keeps a turn, R gives it to user or assistant,
    D deletes it, which blank turns and duplicates must be, I puts in an empty turn; ``audit`` has the cheapest that give
    the roles ``(s?(ua)+)?``, the ASCII-least of several, and ``repaired_sha256`` is of the lines ``role:text`` that are left.

    A null role or text is one space, so a null role must be changed or go, and a null text is blank. An empty role has no
    initial and can't be kept either. Turns of a null conversation are one conversation. ``every`` names conversations to
    report even if they have no turns: zeros, no edits, the hash of the empty text. An empty table gives an empty result,
    other columns are ignored, and repeated turns are duplicates.

    The repaired text's hash needs all turns of a conversation in one order, so a task streams them: it holds one batch of
    turns and the edits that are not certain yet. Faults are found before that, by aggregates that no conversation gathers in.
    """
    blank = F.lit(" ")
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text")
    )
    rows = _faults(rows).withColumn("present", F.lit(True))
    if every is not None:
        rows = rows.unionByName(every.select("conv_id", F.lit(False).alias("present")).distinct(), allowMissingColumns=True)
    # Little to read but much to do for each turn, so adaptive execution should not put tasks together.
    tasks = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(tasks, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text", "place")
    fields = [f"conv_id {dict(turns.dtypes)['conv_id']}", *[f"{n} bigint" for n in _NUMBERS], *[f"{n} string" for n in _TEXTS]]
    return rows.select("conv_id", "present", "turn", "role", "text", "fault").mapInArrow(_repaired, ", ".join(fields))
