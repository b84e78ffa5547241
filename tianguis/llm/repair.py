"""Repairing the structure of conversations by the lightest derivation.

A conversation should read ``(s?(ua)+)?`` in the initials of its roles. The repairs of its rows are items of a weighted
deduction system: a prefix of the rows that leaves the grammar in some state, a row treated in some way, an inserted
turn. A deduction joins a prefix with a treated row or an insertion; the weight of what it derives is the sum of costs
and the joined audit letters. Weights are compared by cost, then by audit. Every deduction is superior and monotone: a
letter more never makes a weight less, and of two prefixes of the same rows and the same cost neither audit begins
with the other (the longer one would hold an insertion more), so the same letters behind both keep their order.
Knuth's agenda therefore finalises items in the order of their weights, and stops at the goal.

Rows are taken in blocks. Inside a block the agenda gives the lightest way between every two states; blocks are joined
by one more deduction. So a conversation of any length is streamed: four weights are held, and the audit letters.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Hashable, Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Weight = tuple[int, str]
Deduction = tuple[tuple[Hashable, ...], Hashable]

# Costs, and what counts as white space and as the end of a sentence.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
INK = r"[^\x20\x09-\x0D]"
ENDED = r"[.!?][\x20\x09-\x0D]*\z"

#: States of the grammar: nothing yet, after s, after u, after a.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
STEP = {(START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A, (AFTER_A, "u"): AFTER_U}
FINAL = (START, AFTER_A)
NAMES = {"u": "user", "a": "assistant"}

#: Rows whose repairs are derived together.
BLOCK = 128
GOAL = "goal"


def joined(*weights: Weight) -> Weight:
    return sum(cost for cost, _ in weights), "".join(audit for _, audit in weights)


def lightest(
    axioms: dict[Hashable, Weight],
    deductions: Iterable[Deduction],
    combine: Callable[..., Weight] = joined,
    goal: Hashable | None = None,
) -> dict[Hashable, Weight]:
    """Knuth's generalisation of Dijkstra's algorithm: the lightest weight of every derivable item, up to the goal.

    ``deductions`` are (antecedents, consequent); ``combine`` gives the weight of the consequent from those of the
    antecedents and must be superior and monotone.
    """
    waiting: dict[Hashable, list[list]] = {}
    for antecedents, consequent in deductions:
        rule = [len(antecedents), antecedents, consequent]
        for item in antecedents:
            waiting.setdefault(item, []).append(rule)
    agenda = [(weight, n, item) for n, (item, weight) in enumerate(axioms.items())]
    heapq.heapify(agenda)
    pushed, final = len(agenda), {}
    while agenda:
        weight, _, item = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = weight
        if item == goal:
            break
        for rule in waiting.get(item, ()):
            rule[0] -= 1
            if rule[0] == 0 and rule[2] not in final:
                heapq.heappush(agenda, (combine(*[final[a] for a in rule[1]]), pushed, rule[2]))
                pushed += 1
    return final


@dataclass(frozen=True)
class Row:
    """What a repair needs to know of a row."""

    initial: str
    must_go: bool = False  # blank or a duplicate
    truncated: bool = False

    def treatments(self) -> list[tuple[str | None, Weight]]:
        """(the initial it then shows, if any; the weight)."""
        if self.must_go:
            return [(None, (DELETE, "D"))]
        more = TRUNCATED if self.truncated else 0
        rerole = [(i, (REROLE + more, "R")) for i in NAMES]
        return [(None, (DELETE, "D")), (self.initial, (more, "K")), *rerole]


def derivations(rows: list[Row], entries: Iterable[int], goal: bool) -> dict[tuple[int, int], Weight]:
    """The lightest weight of treating all the rows, by (state before, state after).

    With ``goal``, there is one entry and the derivation ends with the first accepting state that is final.
    """
    axioms: dict[Hashable, Weight] = {("insert", i): (INSERT, "I") for i in NAMES}
    axioms |= {("at", e, 0, e): (0, "") for e in entries}
    deductions: list[Deduction] = []
    for e in entries:
        for place in range(len(rows) + 1):
            for (state, initial), after in STEP.items():
                if initial in NAMES:
                    deductions.append(((("at", e, place, state), ("insert", initial)), ("at", e, place, after)))
    for place, row in enumerate(rows):
        for nth, (initial, weight) in enumerate(row.treatments()):
            axioms[("row", place, nth)] = weight
            moves = [(s, s) for s in range(4)] if initial is None else [(s, t) for (s, i), t in STEP.items() if i == initial]
            for e in entries:
                deductions += [((("at", e, place, s), ("row", place, nth)), ("at", e, place + 1, t)) for s, t in moves]
    if goal:
        deductions += [((("at", e, len(rows), s),), GOAL) for e in entries for s in FINAL]
    final = lightest(axioms, deductions, goal=GOAL if goal else None)
    if goal:
        return {(START, START): final[GOAL]}
    return {(e, s): final["at", e, len(rows), s] for e in entries for s in range(4) if ("at", e, len(rows), s) in final}


@dataclass(frozen=True)
class Way:
    """A prefix of whole blocks: its cost, and its audit as a chain of parts, one for each block, the last one here."""

    cost: int
    part: str = ""
    before: Way | None = None

    def audit(self) -> str:
        parts, way = [], self
        while way is not None:
            parts.append(way.part)
            way = way.before
        return "".join(reversed(parts))


def lighter(a: Way, b: Way) -> bool:
    """Whether a comes before b; the audits are compared from where the chains part."""
    if a.cost != b.cost:
        return a.cost < b.cost
    x, y = [], []
    while a is not b:
        x.append(a.part)
        y.append(b.part)
        a, b = a.before, b.before
    return "".join(reversed(x)) < "".join(reversed(y))


class Repair:
    """Finds the cheapest repair of rows that arrive one by one."""

    def __init__(self):
        self.rows: list[Row] = []
        self.ways: dict[int, Way] = {START: Way(0)}

    def add(self, row: Row) -> None:
        self.rows.append(row)
        if len(self.rows) == BLOCK:
            self.close_block()

    def close_block(self) -> None:
        found: dict[int, Way] = {}
        for (before, after), (cost, audit) in derivations(self.rows, list(self.ways), goal=False).items():
            way = Way(self.ways[before].cost + cost, audit, self.ways[before])
            if after not in found or lighter(way, found[after]):
                found[after] = way
        self.ways, self.rows = found, []

    def result(self) -> Weight:
        """Cost and audit of the whole."""
        if START in self.ways and self.ways[START].before is None:
            return derivations(self.rows, [START], goal=True)[START, START]
        if self.rows:
            self.close_block()
        best = None
        for state in FINAL:
            way = self.ways.get(state)
            if way is not None and (best is None or lighter(way, best)):
                best = way
        return best.cost, best.audit()


class Rewriter:
    """Applies an audit to the rows it was found for, one by one."""

    def __init__(self, audit: str):
        self.letters, self.state = iter(audit), START

    def _show(self, initial: str) -> None:
        self.state = STEP[self.state, initial]

    def _next_initial(self) -> str:
        return "a" if self.state == AFTER_U else "u"

    def _insert(self) -> str:
        initial = self._next_initial()
        self._show(initial)
        return NAMES[initial] + ":"

    def row(self, role: str, text: str) -> Iterator[str]:
        """The turns that stand for the row and for what is inserted before it."""
        for letter in self.letters:
            if letter == "I":
                yield self._insert()
                continue
            if letter == "K":
                self._show(role[:1])
                yield f"{role}:{text}"
            elif letter == "R":
                initial = self._next_initial()
                self._show(initial)
                yield f"{NAMES[initial]}:{text}"
            return

    def rest(self) -> Iterator[str]:
        """The turns inserted after the last row."""
        for _ in self.letters:
            yield self._insert()


def spelt(name: str) -> Column:
    """A value as text; null is one space."""
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies) of every row, damaged by the checksum of ``conv_id:turn``.

    copies is 0 for a dropped row and 2 for one that is repeated. A null role, text, conv_id or turn counts as one
    space, both here and in the checksum; conv_id and turn stay null.
    """
    which = F.pmod(F.crc32(F.concat(spelt("conv_id"), F.lit(":"), spelt("turn")).cast("binary")), F.lit(20))
    text = F.when(which == 1, "").when(which == 2, F.regexp_replace(spelt("text"), r"[.!?]", "")).otherwise(spelt("text"))
    return rows.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.when(which == 4, "user").otherwise(spelt("role")).alias("role"),
        text.alias("text"),
        F.when(which == 0, 0).when(which == 3, 2).otherwise(1).alias("copies"),
    )


def identity(role: str = "role", text: str = "text") -> Column:
    """A digest that tells pairs of role and text apart."""
    return F.unhex(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))


@dataclass
class Case:
    """What is known of a conversation while its rows pass by."""

    conv_id: int | None
    turns: int = 0
    low: int | None = None
    high: int | None = None
    last_initial: str | None = None
    counts: dict[str, int] = field(default_factory=lambda: dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0))
    repair: Repair = field(default_factory=Repair)

    def add(self, turn: int | None, initial: str, blank: bool, repeated: bool, truncated: bool) -> None:
        if turn is not None and turn != self.high:
            self.turns, self.high = self.turns + 1, turn
            self.low = turn if self.low is None else self.low
        fault = "blank" if blank else "duplicate" if repeated else "truncated" if truncated else None
        if fault:
            self.counts[fault] += 1
        if self.last_initial is not None and self.last_initial + initial not in ("su", "ua", "au"):
            self.counts["illegal"] += 1
        self.last_initial = initial
        self.repair.add(Row(initial, fault in ("blank", "duplicate"), fault == "truncated"))

    def done(self) -> tuple:
        cost, audit = self.repair.result()
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return (self.conv_id, gaps, *self.counts.values(), cost, audit)


FOUND = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
)
_NAMES = [part.split()[0] for part in FOUND.split(", ")]
_TYPES = [pa.int64()] * 7 + [pa.string()]


def _arrow(rows: list[tuple], names: list[str], types: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)


def find_repairs(rows: DataFrame) -> DataFrame:
    """The faults of every conversation of ``rows`` (conv_id, turn, role, text, copies) and its cheapest repair.

    Only digests and marks of the texts travel here. Rows go by turn (null first), then by the digest of role and
    text, so the copies of a row are neighbours; all but the first row of a role and text are duplicates.
    """
    narrow = rows.select(
        "conv_id",
        "turn",
        "copies",
        F.substring("role", 1, 1).alias("initial"),
        (~F.col("text").rlike(INK)).alias("blank"),
        (~F.col("text").rlike(ENDED)).alias("truncated"),
        identity().alias("digest"),
    )
    same = Window.partitionBy("conv_id", "digest").orderBy((F.col("copies") == 0).asc(), F.col("turn").asc_nulls_first())
    numbered = narrow.repartition("conv_id").withColumn("repeated", F.row_number().over(same) > 1)
    ordered = numbered.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "digest", "repeated").drop("digest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        case: Case | None = None
        for batch in batches:
            out = []
            for conv_id, turn, copies, initial, blank, truncated, repeated in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if case is None or conv_id != case.conv_id:
                    if case is not None:
                        out.append(case.done())
                    case = Case(conv_id)
                for copy in range(copies):
                    case.add(turn, initial, blank, repeated or copy > 0, truncated)
            if out:
                yield _arrow(out, _NAMES, _TYPES)
        if case is not None:
            yield _arrow([case.done()], _NAMES, _TYPES)

    return ordered.mapInArrow(run, FOUND)


def _with_headers(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of each conversation in order, behind a row that carries what was found."""
    heads = found.select("conv_id", F.lit(None).cast("bigint").alias("turn"), F.lit(None).cast("string").alias("role"),
                         F.lit(None).cast("string").alias("text"), F.lit(0).alias("copies"), F.struct(*found.columns).alias("found"))
    bodies = rows.where("copies > 0").select("*", F.lit(None).cast(heads.schema["found"].dataType).alias("found"))
    both = heads.unionByName(bodies).withColumn("digest", F.when(F.col("found").isNull(), identity()))
    order = ["conv_id", F.col("found").isNull(), F.col("turn").asc_nulls_first(), "digest"]
    return both.repartition("conv_id").sortWithinPartitions(*order).select("role", "text", "copies", "found")


def repaired_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, place, turn): the repaired turns of every conversation, ``role:text``, from 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv_id, place, rewriter = None, 0, None
        for batch in batches:
            out = []
            for role, text, copies, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                turns = []
                if found is not None:
                    if rewriter is not None:
                        out += [(conv_id, place + i, t) for i, t in enumerate(rewriter.rest())]
                    conv_id, place, rewriter = found["conv_id"], 0, Rewriter(found["audit"])
                for _ in range(copies):
                    turns += rewriter.row(role, text)
                out += [(conv_id, place + i, t) for i, t in enumerate(turns)]
                place += len(turns)
            yield _arrow(out, ["conv_id", "place", "turn"], [pa.int64(), pa.int64(), pa.string()])
        if rewriter is not None:
            out = [(conv_id, place + i, t) for i, t in enumerate(rewriter.rest())]
            yield _arrow(out, ["conv_id", "place", "turn"], [pa.int64(), pa.int64(), pa.string()])

    return _with_headers(rows, find_repairs(rows)).mapInArrow(run, "conv_id bigint, place bigint, turn string")


def digest_repairs(rows: DataFrame) -> DataFrame:
    """A row for each conv_id of ``rows`` (conv_id, turn, role, text, copies; others are ignored): its faults, the cost
    and audit of its cheapest repair, and the digest of the repaired turns.

    A null conv_id is a conversation of its own, a null turn comes first and is no turn for the gaps, and rows of one
    turn go by the digest of role and text. A role that begins with none of s, u, a, or has no letter at all, cannot be
    kept. A conversation without rows (all with copies 0) has zeros and empty texts. An empty table gives an empty result. The texts
    are shuffled once, behind the audit of their conversation; a task holds the audit and one row at a time, since a
    digest over the turns of a conversation is sequential.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, digest, any_turn, rewriter = None, None, False, None
        names, types = [*_NAMES, "repaired_sha256"], [*_TYPES, pa.string()]

        def write(turns: Iterable[str]) -> None:
            nonlocal any_turn
            for turn in turns:
                digest.update((("\n" if any_turn else "") + turn).encode())
                any_turn = True

        def close() -> tuple:
            write(rewriter.rest())
            return (*[head[n] for n in _NAMES], digest.hexdigest())

        for batch in batches:
            out = []
            for role, text, copies, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if found is not None:
                    if head is not None:
                        out.append(close())
                    head, digest, any_turn, rewriter = found, hashlib.sha256(), False, Rewriter(found["audit"])
                for _ in range(copies):
                    write(rewriter.row(role, text))
            if out:
                yield _arrow(out, names, types)
        if head is not None:
            yield _arrow([close()], names, types)

    return _with_headers(rows, find_repairs(rows)).mapInArrow(run, FOUND + ", repaired_sha256 string")
