"""Secret scanning with one combined deterministic automaton.

Rule expressions become a non-deterministic automaton, subset construction makes it deterministic, partition
refinement makes it minimal, and byte classes make its transition array small. One automaton of all rules' seek
expressions reads every byte once; a line in which it accepts is resolved rule by rule with anchored automata made
the same way. No rule matches across a line feed, so lines are read side by side.

A match is the leftmost, then longest one, matches do not overlap within a rule, and a match that its rule's full
expression does not accept is dropped without another try.

Defined results: a null or empty text has no spans and the hash of the empty string; rows that repeat an id are
scanned one by one; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re._constants as op
import re._parser as parser
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerloom.llm.text import pieces, utf8

VALUE = "[A-Za-z0-9+/_.=-]"
ASSIGN = r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?" + VALUE


@dataclass(frozen=True)
class Rule:
    """``seek`` matches somewhere in every line with a match of ``full``; ``loose`` gives the extent of a match."""

    kind: str
    seek: str
    loose: str
    full: str


RULES = (
    Rule("assign", ASSIGN, ASSIGN + "+", ASSIGN + "{6,}"),
    Rule("access", "AKIA[A-Z0-9]", "AKIA[A-Z0-9]+", "AKIA[A-Z0-9]{16,}"),
    Rule("hex", "[0-9a-f]{24}", "[0-9a-f]+", "[0-9a-f]{24,}"),
    Rule("private_key", "-----BEGIN ", "-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----", "-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----"),
    Rule("code_host", "gh[pousr]_", "gh[pousr]_[A-Za-z0-9]+", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", "xox[abprs]-", "xox[abprs]-[A-Za-z0-9-]+", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud_key", "AIza", "AIza[A-Za-z0-9_-]+", "AIza[A-Za-z0-9_-]{35,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    Rule("url_login", "://[^\\x00-\\x20:/@]+:", "://[^\\x00-\\x20:/@]+:[^\\x00-\\x20:/@]+@", "://[^\\x00-\\x20:/@]+:[^\\x00-\\x20:/@]+@"),
)
BASE = 3
KINDS = tuple(r.kind for r in RULES)
SPANS = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


class Nfa:
    """States with byte-set moves and empty moves."""

    def __init__(self) -> None:
        self.moves: list[list[tuple[frozenset[int], int]]] = []
        self.empty: list[list[int]] = []

    def state(self) -> int:
        self.moves.append([])
        self.empty.append([])
        return len(self.moves) - 1

    def closure(self, states: frozenset[int]) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for t in self.empty[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)

    def add(self, tree, start: int, fold: bool = False) -> int:
        """Append a parsed expression after ``start``; the state where it ends."""
        for kind, arg in tree:
            if kind in (op.LITERAL, op.NOT_LITERAL, op.IN):
                end = self.state()
                self.moves[start].append((_byte_set(kind, arg, fold), end))
                start = end
            elif kind is op.SUBPATTERN:
                start = self.add(arg[3], start, fold or bool(arg[1] & 2))
            elif kind is op.BRANCH:
                end = self.state()
                for branch in arg[1]:
                    self.empty[self.add(branch, start, fold)].append(end)
                start = end
            elif kind is op.MAX_REPEAT:
                low, high, body = arg
                for _ in range(low):
                    start = self.add(body, start, fold)
                if high is op.MAXREPEAT:
                    loop = self.state()
                    self.empty[start].append(loop)
                    self.empty[self.add(body, loop, fold)].append(loop)
                    start = loop
                else:
                    end = self.state()
                    for _ in range(high - low):
                        self.empty[start].append(end)
                        start = self.add(body, start, fold)
                    self.empty[start].append(end)
                    start = end
            else:
                raise ValueError(f"a rule uses {kind}, which automata here don't know")
        return start


def _byte_set(kind, arg, fold: bool) -> frozenset[int]:
    if kind is not op.IN:
        found, negated = {arg}, kind is op.NOT_LITERAL
    else:
        found, negated = set(), False
        for what, value in arg:
            if what is op.NEGATE:
                negated = True
            elif what is op.LITERAL:
                found.add(value)
            else:
                found.update(range(value[0], value[1] + 1))
    if fold:
        found |= {ord(chr(b).swapcase()) for b in found if b < 128 and chr(b).isalpha()}
    return frozenset(range(256)) - found if negated else frozenset(found)


@dataclass
class Automaton:
    """Minimal deterministic automaton: next state = move[state * width + classes[byte]].

    ``accepts`` has a bit for each expression; state 0 is the start; ``dead`` can't accept any more (or is -1).
    """

    classes: np.ndarray
    move: np.ndarray
    width: int
    accepts: np.ndarray
    dead: int


def compile_rules(expressions: list[str], anywhere: bool = False) -> Automaton:
    """``anywhere``: a match may begin at any byte, and accepting states stay so."""
    nfa = Nfa()
    start = nfa.state()
    if anywhere:
        nfa.moves[start].append((frozenset(range(256)), start))
    ends = [nfa.add(parser.parse(e), _branch(nfa, start)) for e in expressions]
    sets = list({s for moves in nfa.moves for s, _ in moves})
    rows, classes = np.unique(np.array([[b in s for s in sets] for b in range(256)]), axis=0, return_inverse=True)
    classes = classes.reshape(-1)
    member = [int(np.flatnonzero(classes == c)[0]) for c in range(len(rows))]
    first = nfa.closure(frozenset([start]))
    number, todo, table, accepts = {first: 0}, [first], [], []
    while todo:
        here = todo.pop(0)
        bits = sum(1 << k for k, e in enumerate(ends) if e in here)
        accepts.append(bits)
        row = []
        for byte in member:
            to = here if anywhere and bits else nfa.closure(frozenset(t for s in here for allowed, t in nfa.moves[s] if byte in allowed))
            if to not in number:
                number[to] = len(number)
                todo.append(to)
            row.append(number[to])
        table.append(row)
    return _minimal(np.array(table), np.array(accepts), classes)


def _branch(nfa: Nfa, start: int) -> int:
    state = nfa.state()
    nfa.empty[start].append(state)
    return state


def _minimal(table: np.ndarray, accepts: np.ndarray, classes: np.ndarray) -> Automaton:
    """Merge states that no input tells apart, by refining the partition of equal acceptance."""
    _, part = np.unique(accepts, return_inverse=True)
    while True:
        _, finer = np.unique(np.concatenate([part[:, None], part[table]], 1), axis=0, return_inverse=True)
        finer = finer.reshape(-1)
        if finer.max() == part.max():
            break
        part = finer
    order = np.argsort([np.flatnonzero(part == p)[0] for p in range(part.max() + 1)])
    rank = np.argsort(order)
    part = rank[part]
    keep = np.array([np.flatnonzero(part == p)[0] for p in range(part.max() + 1)])
    move = part[table[keep]]
    accepts = accepts[keep]
    dead = [p for p in range(len(keep)) if not accepts[p] and (move[p] == p).all()]
    return Automaton(classes.astype(np.intp), move.reshape(-1).astype(np.int32), table.shape[1], accepts, dead[0] if dead else -1)


@cache
def compiled(rules: tuple[Rule, ...] = RULES) -> tuple[Automaton, list[Automaton], list[Automaton]]:
    """The combined automaton of all seek expressions; for each rule the unanchored and the anchored one."""
    combined = compile_rules([r.seek for r in rules], anywhere=True)
    return combined, [compile_rules([r.loose], anywhere=True) for r in rules], [compile_rules([r.loose, r.full]) for r in rules]


NARROW = 32


def hit_lines(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, automaton: Automaton) -> np.ndarray:
    """Which lines the automaton accepts: all lines advance together, one byte at a time, long ones last."""
    order = np.argsort(starts - ends, kind="stable")
    begin, size = starts[order], (ends - starts)[order]
    state = np.zeros(len(order), np.intp)
    symbols = automaton.classes[data]
    move, width = automaton.move, automaton.width
    active, at = len(order), 0
    shorter = np.searchsorted(-size, -np.arange(int(size[0]) + 1 if len(size) else 1), "left")
    while at < len(shorter) - 1:
        active = shorter[at]
        if active < NARROW:
            break
        state[:active] = move[state[:active] * width + symbols[begin[:active] + at]]
        at += 1
    rows = [move[k : k + width].tolist() for k in range(0, len(move), width)]
    for lane in np.flatnonzero(size > at).tolist():
        s = int(state[lane])
        for c in symbols[begin[lane] + at : begin[lane] + size[lane]].tolist():
            s = rows[s][c]
        state[lane] = s
    return np.sort(order[automaton.accepts[state] > 0])


def resolve(line: bytes, loose: Automaton, anchored: Automaton) -> list[tuple[int, int]]:
    """Spans of one rule in a line."""
    out, pos, n = [], 0, len(line)
    seek = loose.classes[np.frombuffer(line, np.uint8)].tolist()
    walk = anchored.classes[np.frombuffer(line, np.uint8)].tolist()
    while pos < n:
        s, fresh, end = 0, pos, -1
        for at in range(pos, n):
            s = int(loose.move[s * loose.width + seek[at]])
            if loose.accepts[s]:
                end = at + 1
                break
            if s == 0:
                fresh = at + 1
        if end < 0:
            break
        for begin in range(fresh, end):
            s, last, full = 0, -1, False
            for at in range(begin, n):
                s = int(anchored.move[s * anchored.width + walk[at]])
                if s == anchored.dead:
                    break
                if anchored.accepts[s] & 1:
                    last, full = at + 1, bool(anchored.accepts[s] & 2)
            if last >= 0:
                if full:
                    out.append((begin, last))
                pos = last
                break
    return out


def find_spans(column: pa.Array, rules: tuple[Rule, ...] = RULES) -> dict[int, list[tuple[int, int, int]]]:
    """For each text with spans: (start, rule, end) in code points, by start, then rule."""
    data, offsets = utf8(column)
    combined, loose, anchored = compiled(rules)
    edges = np.union1d(np.flatnonzero(data == 10), offsets[1:])
    starts = np.concatenate([[0], edges[:-1]])
    found: dict[int, list[tuple[int, int, int]]] = {}
    raw = data.tobytes() if len(data) else b""
    real = np.flatnonzero(edges > starts)
    starts, ends = starts[real], edges[real]
    for k in hit_lines(data, starts, ends, combined).tolist():
        a, b = int(starts[k]), int(ends[k])
        doc = int(np.searchsorted(offsets, a, "right")) - 1
        spans = [(a + s, r, a + e) for r in range(len(rules)) for s, e in resolve(raw[a:b], loose[r], anchored[r])]
        if spans:
            found.setdefault(doc, []).extend(spans)
    for doc, spans in found.items():
        low = int(offsets[doc])
        points = np.concatenate([[0], np.cumsum((data[low : offsets[doc + 1]] & 0xC0) != 0x80)])
        found[doc] = sorted((int(points[s - low]), r, int(points[e - low])) for s, r, e in spans)
    return found


def scan(documents: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of every row, in one map pass."""
    kinds = [r.kind for r in rules]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = hashlib.sha256(b"").hexdigest()
        for piece in pieces(batches):
            n = piece.num_rows
            counts, sha, text = np.zeros((BASE, n), np.int64), [none] * n, [""] * n
            for doc, spans in find_spans(piece.column("text"), rules).items():
                named = [f"{kinds[r]}:{s}:{e}" for s, r, e in spans]
                base = [name for name, x in zip(named, spans) if x[1] < BASE]
                counts[:, doc] = np.bincount([x[1] for x in spans if x[1] < BASE], minlength=BASE)
                sha[doc], text[doc] = hashlib.sha256(",".join(base).encode()).hexdigest(), ",".join(named)
            columns = [piece.column("doc_id"), *map(pa.array, counts), pa.array(sha), pa.array(text)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {SPANS}")
