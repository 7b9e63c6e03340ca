"""Repair of conversation structure by generalised LR with a graph-structured stack.

The role grammar gives the legal sequences: nothing, or an optional system turn and then pairs of a user and an assistant
turn. Its SLR tables are built from the rules. A conversation is read turn by turn; for each turn every live stack is
extended by Keep (the turn's own role), Rerole (to user or assistant), Delete, and around turns by Insert (an empty user
or assistant turn), each with its cost. Stacks with equal tops merge: the one with the least (cost, audit) keeps its
links. That loses nothing, since in this grammar the top alone decides what may follow, and since of two audits of equal
cost for the same turns neither begins the other, so that the smaller one stays smaller whatever comes next.

Costs of the live stacks relative to the cheapest, the order of their audits and the few letters by which one may still
begin another make up a configuration. Stacks too dear to win are dropped, so there are few, and each step is looked up
after its first time. What a stack has
produced so far is its value: here the running digest of its repaired turns. A task therefore holds, for the
conversation it reads, four digests and one reference a turn, not the texts.

Faults of a turn, the first that holds: blank (no visible character), duplicate (role and text occurred earlier in the
conversation), truncated (the last visible character ends no sentence). Blank and duplicate turns must be deleted; a
truncated one that stays costs extra.

Rows are shuffled once, by conversation, and sorted on disk where they do not fit. A conversation's digest is one chain
over its turns, so a conversation is read by one task, as a stream; its length costs time there but no memory beyond the
audit it returns.

Defined results: turns are taken by turn number, nulls first, ties by role, then text; a null role or text is one space
(so a null text is blank); a role that is none of the grammar's can only be reroled or deleted; rows with a null
conversation id form one conversation; repeated rows are duplicates; a conversation without present rows has zeros, an
empty audit and the digest of nothing; an empty table gives no rows; further columns are ignored. Very long texts only
pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ROLES = {"s": "system", "u": "user", "a": "assistant"}
#: Head and body of each rule; the first rule's head is the start symbol. Small letters are terminals.
GRAMMAR = (("Talk", ""), ("Talk", ("Pairs",)), ("Talk", ("s", "Pairs")), ("Pairs", ("Pair",)), ("Pairs", ("Pairs", "Pair")), ("Pair", ("u", "a")))
END = "."
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: A stack that costs more than this above the cheapest cannot win: with two insertions, and by deleting the one system turn
#: that the other could still keep, the cheapest can be followed by whatever follows the other.
SLACK = 2 * INSERT + DELETE
NONE, BLANK, DUPLICATE, CUT = 0, 1, 2, 3
#: Rows and characters of a batch of results.
OUT_ROWS, OUT_CHARS = 2_000, 1 << 22


class Tables:
    """SLR tables of a grammar: actions by (state, terminal) and gotos by (state, nonterminal)."""

    def __init__(self, grammar=GRAMMAR):
        self.rules = [(head, tuple(body)) for head, body in grammar]
        heads = {head for head, _ in self.rules}
        start = ("", (self.rules[0][0],))
        rules = [*self.rules, start]
        symbols = sorted({x for _, body in rules for x in body})
        empty, first, follow = set(), {h: set() for h in heads}, {h: set() for h in heads}
        follow[self.rules[0][0]].add(END)
        size = None
        while size != (size := len(empty) + sum(map(len, first.values())) + sum(map(len, follow.values()))):
            for head, body in self.rules:
                after = set(follow[head])
                for x in reversed(body):
                    if x in heads:
                        follow[x] |= after
                        after = (after if x in empty else set()) | first[x]
                    else:
                        after = {x}
                for x in body:
                    first[head] |= first[x] if x in heads else {x}
                    if x not in empty:
                        break
                else:
                    empty.add(head)

        def closure(items: frozenset) -> frozenset:
            out, new = set(items), list(items)
            while new:
                rule, dot = new.pop()
                body = rules[rule][1]
                if dot < len(body):
                    for k, (head, _) in enumerate(self.rules):
                        if head == body[dot] and (k, 0) not in out:
                            out.add((k, 0))
                            new.append((k, 0))
            return frozenset(out)

        states = [closure(frozenset({(len(self.rules), 0)}))]
        self.shift, self.goto, self.reduce, self.accept = {}, {}, {}, set()
        for state, items in enumerate(states):
            for x in symbols:
                moved = frozenset((r, dot + 1) for r, dot in items if rules[r][1][dot : dot + 1] == (x,))
                if moved:
                    target = closure(moved)
                    if target not in states:
                        states.append(target)
                    (self.goto if x in heads else self.shift)[state, x] = states.index(target)
            for r, dot in items:
                if dot == len(rules[r][1]):
                    if r == len(self.rules):
                        self.accept.add(state)
                    else:
                        for x in follow[rules[r][0]]:
                            self.reduce[state, x] = r

    def read(self, stack: tuple[int, ...], terminal: str) -> tuple[int, ...] | None:
        """The stack after a terminal (for ``END``: the same stack if the input may end), None where it cannot follow."""
        before = stack
        while True:
            if terminal == END and stack[-1] in self.accept:
                return before
            if (stack[-1], terminal) in self.shift:
                return (*stack, self.shift[stack[-1], terminal])
            rule = self.reduce.get((stack[-1], terminal))
            if rule is None:
                return None
            head, body = self.rules[rule]
            stack = stack[: len(stack) - len(body)]
            stack = (*stack, self.goto[stack[-1], head])


TABLES = Tables()


class Move(NamedTuple):
    """How a stack came about: from which one, by which edit of the turn, as which role, and what was inserted after it."""

    source: int
    edit: str
    role: str
    inserted: str

    @property
    def audit(self) -> str:
        return self.edit + "I" * len(self.inserted)


class Live(NamedTuple):
    """A live stack: its links, cost above the cheapest, the rank of its audit and the letters after what that rank stands for."""

    stack: tuple[int, ...]
    cost: int
    rank: int
    rest: str


def _settled(offers: dict[int, tuple]) -> tuple[int, tuple[Live, ...], tuple[Move, ...]]:
    """Insertions added, equal tops merged, and costs and audits made relative."""
    moved = True
    while moved:
        moved = False
        for cost, rank, rest, stack, move in list(offers.values()):
            for role in "ua":
                following = TABLES.read(stack, role)
                if following:
                    offer = (cost + INSERT, rank, rest + "I", following, move._replace(inserted=move.inserted + role))
                    if following[-1] not in offers or offer[:3] < offers[following[-1]][:3]:
                        offers[following[-1]], moved = offer, True
    base = min(offer[0] for offer in offers.values())
    offers = {top: offer for top, offer in offers.items() if offer[0] <= base + SLACK}
    order = sorted(offers.values(), key=lambda offer: offer[1:3])
    place, rank, head = {}, -1, None
    for offer in order:  # an audit that begins another shares its rank, the other keeps the rest
        if head is None or offer[1] != head[0] or not offer[2].startswith(head[1]):
            rank, head = rank + 1, (offer[1], offer[2])
        place[offer[3][-1]] = (rank, offer[2][len(head[1]) :])
    tops = sorted(offers)
    live = tuple(Live(offers[t][3], offers[t][0] - base, *place[t]) for t in tops)
    return base, live, tuple(offers[t][4] for t in tops)


@lru_cache(maxsize=None)
def begin() -> tuple[int, tuple[Live, ...], tuple[Move, ...]]:
    return _settled({0: (0, 0, "", (0,), Move(-1, "", "", ""))})


@lru_cache(maxsize=None)
def step(live: tuple[Live, ...], initial: str, fault: int) -> tuple[int, tuple[Live, ...], tuple[Move, ...]]:
    """What a turn does to a configuration: cost of the cheapest stack, the new configuration, and its moves."""
    offers: dict[int, tuple] = {}

    def offer(cost: int, at: int, stack: tuple[int, ...] | None, edit: str, role: str) -> None:
        if stack:
            new = (live[at].cost + cost, live[at].rank, live[at].rest + edit, stack, Move(at, edit, role, ""))
            if stack[-1] not in offers or new[:3] < offers[stack[-1]][:3]:
                offers[stack[-1]] = new

    for at, one in enumerate(live):
        offer(DELETE, at, one.stack, "D", "")
        if fault not in (BLANK, DUPLICATE):
            extra = TRUNCATED if fault == CUT else 0
            if initial in ROLES:
                offer(extra, at, TABLES.read(one.stack, initial), "K", "")
            for role in "ua":
                if role != initial:
                    offer(REROLE + extra, at, TABLES.read(one.stack, role), "R", role)
    return _settled(offers)


class Digest:
    """The running digest of a stack's repaired turns, one ``role:text`` a line."""

    __slots__ = ("state", "some")

    def __init__(self):
        self.state, self.some = hashlib.sha256(), False

    def extended(self, lines: list[tuple[str, bytes]]) -> Digest:
        if not lines:
            return self
        out = Digest()
        out.state, out.some = self.state.copy(), True
        for k, (role, text) in enumerate(lines):
            out.state.update((("\n" if self.some or k else "") + role + ":").encode())
            out.state.update(text)
        return out


class Repair:
    """The stacks of one conversation while its turns are read."""

    def __init__(self, digests: bool):
        self.cost, self.live, moves = begin()
        self.trail = [moves]
        start = Digest() if digests else None
        self.values = [start.extended([(ROLES[x], b"") for x in m.inserted]) for m in moves] if digests else None

    def turn(self, role: str, text: str, fault: int) -> None:
        cost, self.live, moves = step(self.live, role[:1] if role[:1] in ROLES else "", fault)
        self.cost += cost
        self.trail.append(moves)
        if self.values is not None:
            body = text.encode()
            before, self.values = self.values, []
            for m in moves:
                lines = [] if m.edit == "D" else [(ROLES[m.role] if m.role else role, body)]
                self.values.append(before[m.source].extended(lines + [(ROLES[x], b"") for x in m.inserted]))

    def end(self) -> tuple[int, str, list[Move], str]:
        """(cost, audit, moves, digest) of the cheapest stack that may end; ties go to the smallest audit."""
        final = [k for k, one in enumerate(self.live) if TABLES.read(one.stack, END)]
        at = best = min(final, key=lambda k: self.live[k][1:])
        path = []
        for moves in reversed(self.trail):
            path.append(moves[at])
            at = path[-1].source
        path.reverse()
        digest = self.values[best].state.hexdigest() if self.values is not None else ""
        return self.cost + self.live[best].cost, "".join(m.audit for m in path), path, digest


VISIBLE = r"[^\\x20\\x09-\\x0D]"
WHITE = "\\t\\n\\u000B\\u000C\\r "


def _order() -> list:
    return [F.desc("present"), F.asc_nulls_first("turn"), "role", "text", "copy"]


def ordered(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, present, fault, place) with conversations together and in order within each partition.

    A row whose ``present`` (true if there is no such column) is not true only names its conversation; its place is null.
    """
    present = "coalesce(present, false)" if "present" in conversations.columns else "true"
    rows = conversations.selectExpr("conv_id", "turn", "coalesce(role, ' ') as role", "coalesce(text, ' ') as text", f"{present} as present").repartition("conv_id")
    # Both windows and the task that reads a conversation use the same shuffle.
    same = Window.partitionBy("conv_id", "present", "role", F.md5("text")).orderBy(F.asc_nulls_first("turn"))
    rows = rows.withColumn("copy", F.row_number().over(same))
    fault = f"""CASE WHEN NOT text rlike '{VISIBLE}' THEN {BLANK} WHEN copy > 1 THEN {DUPLICATE}
      WHEN right(trim(TRAILING '{WHITE}' FROM text), 1) NOT IN ('.', '!', '?') THEN {CUT} ELSE {NONE} END"""
    here = Window.partitionBy("conv_id").orderBy(*_order())
    rows = rows.withColumn("fault", F.expr(fault)).withColumn("place", F.row_number().over(here))
    rows = rows.sortWithinPartitions("conv_id", *_order())
    return rows.select("conv_id", "turn", "role", "text", "present", "fault", F.when(F.col("present"), F.col("place")).alias("place"))


def _kind(rows: DataFrame) -> str:
    return rows.schema["conv_id"].dataType.simpleString()


REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
LEGAL = {"su", "ua", "au"}


def _conversations(batches: Iterator[pa.RecordBatch], digests: bool) -> Iterator[tuple]:
    """(conversation id, counts, end of the repair) of each conversation of a sorted partition."""
    current, repair, counts = None, None, None
    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in ("conv_id", "turn", "role", "text", "present", "fault")]
        for conv, turn, role, text, present, fault in zip(*columns):
            if repair is None or conv != current:
                if repair is not None:
                    yield current, counts, repair.end()
                current, repair, counts = conv, Repair(digests), {"turns": 0, "faults": [0] * 4, "illegal": 0, "first": None, "last": None, "role": None}
            if not present:
                continue
            if turn is not None and turn != counts["last"]:
                counts["first"] = turn if counts["first"] is None else counts["first"]
                counts["last"], counts["turns"] = turn, counts["turns"] + 1
            counts["faults"][fault] += 1
            counts["illegal"] += counts["role"] is not None and counts["role"] + role[:1] not in LEGAL
            counts["role"] = role[:1]
            repair.turn(role, text, fault)
    if repair is not None:
        yield current, counts, repair.end()


def repair(conversations: DataFrame) -> DataFrame:
    """Faults, cheapest repair and digest of the repaired turns of every conversation."""
    rows = ordered(conversations)
    kind = _kind(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            key, *rest = zip(*found)
            return pa.RecordBatch.from_arrays([pa.array(key, key_type), *map(pa.array, rest)], names)

        names = ["conv_id", *(field.split()[0] for field in REPORT.split(", "))]
        found, chars, key_type = [], 0, None

        def typed() -> Iterator[pa.RecordBatch]:
            nonlocal key_type
            for batch in batches:
                key_type = batch.schema.field("conv_id").type
                yield batch

        for conv, counts, (cost, audit, _, digest) in _conversations(typed(), True):
            gaps = counts["last"] - counts["first"] + 1 - counts["turns"] if counts["turns"] else 0
            found.append((conv, gaps, *counts["faults"][BLANK:], counts["illegal"], cost, audit, digest))
            chars += len(audit)
            if len(found) >= OUT_ROWS or chars >= OUT_CHARS:
                yield out()
                found, chars = [], 0
        if found:
            yield out()

    return rows.select("conv_id", "turn", "role", "text", "present", "fault").mapInArrow(run, f"conv_id {kind}, {REPORT}")


def repaired_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, step, edit, turn, role, text) of every edit of the cheapest repairs, in order of ``step``.

    Deleted turns are listed with edit D and their old role; inserted ones have no turn and an empty text. The edits are
    found without the texts and joined to them by place, so a long conversation's texts are spread over the cluster.
    """
    rows = ordered(conversations)
    kind = _kind(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key_type = None

        def typed() -> Iterator[pa.RecordBatch]:
            nonlocal key_type
            for batch in batches:
                key_type = batch.schema.field("conv_id").type
                yield batch

        def out() -> pa.RecordBatch:
            key, *rest = zip(*found)
            kinds = (pa.int64(), pa.string(), pa.int32(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(key, key_type), *map(pa.array, rest, kinds)], ["key", "step", "edit", "at", "as_role"])

        found: list[tuple] = []
        for conv, _, (_, _, path, _) in _conversations(typed(), False):
            number = 0
            for place, m in enumerate(path):
                edits = ([(m.edit, place, ROLES.get(m.role))] if m.edit else []) + [("I", None, ROLES[x]) for x in m.inserted]
                for edit, at, role in edits:
                    found.append((conv, number, edit, at, role))
                    number += 1
                if len(found) >= OUT_ROWS:
                    yield out()
                    found = []
        if found:
            yield out()

    bare = rows.select("conv_id", F.lit(None).cast("long").alias("turn"), "role", F.lit("").alias("text"), "present", "fault")
    edits = bare.mapInArrow(run, f"key {kind}, step long, edit string, at int, as_role string")
    joined = edits.join(rows.where("present"), F.col("key").eqNullSafe(F.col("conv_id")) & (F.col("at") == F.col("place")), "left")
    return joined.select(F.col("key").alias("conv_id"), "step", "edit", "turn", F.coalesce("as_role", "role").alias("role"), F.coalesce("text", F.lit("")).alias("text"))


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, present): some turns dropped, emptied, cut, repeated or given to the user.

    What happens follows from the checksum of ``conv_id:turn``, where null is one space. Dropped rows stay, not present.
    """
    dealt = "crc32(concat(coalesce(cast(conv_id as string), ' '), ':', coalesce(cast(turn as string), ' '))) % 20"
    rows = conversations.selectExpr("conv_id", "turn", "coalesce(role, ' ') as role", "coalesce(text, ' ') as text", f"{dealt} as d")
    return rows.selectExpr(
        "conv_id",
        "turn",
        "CASE d WHEN 4 THEN 'user' ELSE role END as role",
        "CASE d WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END as text",
        "d <> 0 as present",
        "explode(CASE d WHEN 3 THEN array(1, 2) ELSE array(1) END) as copy_of",
    ).drop("copy_of")
