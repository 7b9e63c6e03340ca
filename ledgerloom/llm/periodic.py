"""Periodic runs of words, found by descending-LCP Kruskal over suffix classes.

A run is a stretch of consecutive words whose words ``period`` apart are identical, with the smallest such period, at
least ``max(MIN_LENGTH, MIN_PERIODS * period)`` words long, that no neighbouring word extends.

The suffixes of a text are ordered by prefix doubling and the longest common prefix (LCP) of each pair of neighbours is
read off the doubling ranks. Pairs are taken by decreasing LCP and unite their suffix classes; every class keeps its
positions in order, the smaller set is inserted into the larger one. Once a level l is done, two positions x < y that
became neighbours on it, at distance d = y - x, share exactly l words. If l reaches both (MIN_PERIODS - 1) * d and
MIN_LENGTH - d, and the words before x and y differ, then [x, y + l) is a run of period d; a smaller period would have
put another position of the class between x and y, and every run is met, at its first word and level length - period.

A run needs two positions that share ``LEAST_SHARED`` words, so a vectorised pass first picks the texts in which some
window of that many words occurs twice; the others have no run. The pass works on pieces of about a megabyte. A text
with repeats takes four bytes a word for each doubling of its longest repeat, in the task that reads it; texts are
never split and nothing is shuffled.

Defined results: a null or empty text has no words, no runs and an empty collapsed text; repeated rows give repeated
results; a null id is returned as null; an empty table gives no rows; further columns are ignored by ``find_runs`` and
kept by ``collapse``. Words are compared as written; very long texts are worked on whole.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.text import mix, pieces, shingles, utf8, word_hashes, words

MIN_LENGTH, MIN_PERIODS = 24, 3
#: length - period is least at period MIN_LENGTH / MIN_PERIODS, for any shorter and longer period it is larger.
LEAST_SHARED = MIN_LENGTH - MIN_LENGTH // MIN_PERIODS
BLOCK = 512

RUNS = "array<struct<start:long,length:long,period:long>>"
_STRUCT = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


class Positions:
    """Integers in order, in blocks, so that an insertion moves at most two blocks' worth of them."""

    __slots__ = ("blocks", "size")

    def __init__(self, first: int):
        self.blocks, self.size = [[first]], 1

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block

    def insert(self, value: int) -> tuple[int, int]:
        """Insert a new value and return its neighbours, -1 where there is none."""
        blocks = self.blocks
        low, high = 0, len(blocks) - 1
        while low < high:
            middle = (low + high) // 2
            if blocks[middle][-1] < value:
                low = middle + 1
            else:
                high = middle
        block = blocks[low]
        at = bisect_left(block, value)
        before = block[at - 1] if at else blocks[low - 1][-1] if low else -1
        after = block[at] if at < len(block) else -1
        block.insert(at, value)
        self.size += 1
        if len(block) > 2 * BLOCK:
            blocks[low : low + 1] = [block[:BLOCK], block[BLOCK:]]
        return before, after


def suffix_pairs(ids: np.ndarray, least: int = LEAST_SHARED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbours in suffix order that share at least ``least`` words, and how many they share.

    Rank level k numbers the suffixes by their first 2**k words; only groups not yet parted are sorted again.
    """
    n = len(ids)
    _, group, count = np.unique(ids, return_inverse=True, return_counts=True)
    rank = (np.cumsum(count) - count)[group].astype(np.int32)
    levels, active = [rank], np.flatnonzero(count[group] > 1)
    while len(active) and 1 << (len(levels) - 1) < n:
        step = 1 << (len(levels) - 1)
        ahead = active + step
        following = np.where(ahead < n, rank[np.minimum(ahead, n - 1)].astype(np.int64) + 1, 0)
        key = rank[active].astype(np.int64) * (n + 1) + following
        order = np.argsort(key, kind="stable")
        active, key = active[order], key[order]
        old = rank[active]
        place = np.arange(len(active))
        new_old, new_key = np.ones(len(active), bool), np.ones(len(active), bool)
        new_old[1:], new_key[1:] = old[1:] != old[:-1], key[1:] != key[:-1]
        head_old = np.maximum.accumulate(np.where(new_old, place, 0))
        head_key = np.maximum.accumulate(np.where(new_key, place, 0))
        rank = rank.copy()
        rank[active] = old + (head_key - head_old)
        levels.append(rank)
        alone = new_key & np.append(new_key[1:], True)
        active = active[~alone]
    order = np.argsort(rank, kind="stable")
    left, right = order[:-1], order[1:]
    # Pairs that share fewer words than the largest power of two up to ``least`` are out at once.
    coarse = min(len(levels) - 1, least.bit_length() - 1)
    near = levels[coarse][left] == levels[coarse][right]
    left, right = left[near], right[near]
    shared = np.zeros(len(left), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = left + shared, right + shared
        fits = np.maximum(x, y) < n
        same = fits & (levels[k][np.minimum(x, n - 1)] == levels[k][np.minimum(y, n - 1)])
        shared[same] += 1 << k
    keep = shared >= least
    return left[keep], right[keep], shared[keep]


def runs_of(ids: np.ndarray, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a sequence of integers, by start, then period."""
    least = min(max(min_length, min_periods * d) - d for d in range(1, min_length + 1))
    if len(ids) <= least:
        return []
    left, right, shared = suffix_pairs(ids, max(least, 1))
    order = np.argsort(-shared, kind="stable")
    left, right, shared = left[order].tolist(), right[order].tolist(), shared[order].tolist()
    word, n = ids.tolist(), len(ids)
    sets: dict[int, Positions] = {}
    root: dict[int, int] = {}
    following: dict[int, int] = {}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    found, touched = set(), set()
    for k, level in enumerate(shared):
        for x in (left[k], right[k]):
            if x not in root:
                root[x], sets[x], following[x] = x, Positions(x), -1
        a, b = find(left[k]), find(right[k])
        if sets[a].size < sets[b].size:
            a, b = b, a
        root[b] = a
        large = sets[a]
        for x in sets.pop(b):
            before, after = large.insert(x)
            following[x] = after
            touched.add(x)
            if before >= 0:
                following[before] = x
                touched.add(before)
        if k + 1 < len(shared) and shared[k + 1] == level:
            continue
        for x in touched:  # the level is done: its neighbours are final for it
            y = following[x]
            d = y - x
            if y < 0 or level < (min_periods - 1) * d or level < min_length - d:
                continue
            if (x == 0 or word[x - 1] != word[y - 1]) and (y + level == n or word[x + level] != word[y + level]):
                found.add((x, d + level, d))
        touched.clear()
    return sorted(found, key=lambda run: (run[0], run[2]))


def _repeating(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Texts in which some window of ``LEAST_SHARED`` words occurs twice."""
    window, at = shingles(h, bounds, LEAST_SHARED)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(at))
    key = mix(window + text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key)
    twice = order[1:][key[order[1:]] == key[order[:-1]]]
    return np.unique(text[twice])


def _gather(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Each text's words joined by one space."""
    size = ends - starts + 1
    last = bounds[1:][np.diff(bounds) > 0] - 1
    size[last] -= 1
    stop = np.cumsum(size)
    index = np.arange(stop[-1] if len(stop) else 0) + np.repeat(starts - (stop - size), size)
    out = np.append(data, np.uint8(32))[np.minimum(index, len(data))]
    space = np.ones(len(size), bool)
    space[last] = False
    out[stop[space] - 1] = 32
    offsets = np.append(0, stop)[bounds]
    return pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(out)).cast(pa.string())


def _scan(column: pa.Array) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """Numbers of words, runs and collapsed texts of a piece."""
    found = words(*utf8(column), lower=False)
    keep = np.ones(len(found.starts), bool)
    per_text: list[list[tuple[int, int, int]]] = [[] for _ in range(len(column))]
    for d in _repeating(word_hashes(found), found.bounds).tolist():
        low, high = int(found.bounds[d]), int(found.bounds[d + 1])
        number: dict[bytes, int] = {}
        ids = np.fromiter((number.setdefault(w, len(number)) for w in found.take(np.arange(low, high))), np.int64, high - low)
        per_text[d] = runs_of(ids)
        for start, length, period in per_text[d]:
            keep[low + start + period : low + start + length] = False
    counts = np.concatenate([[0], np.cumsum(keep)])
    collapsed = _gather(found.data, found.starts[keep], found.ends[keep], counts[found.bounds])
    flat = [run for runs in per_text for run in runs]
    parts = [pa.array([run[k] for run in flat], pa.int64()) for k in range(3)]
    ends = np.concatenate([[0], np.cumsum([len(runs) for runs in per_text])])
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(parts, fields=list(_STRUCT)))
    return found.counts.astype(np.int64), lists, collapsed


def find_runs(documents: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row; ``collapsed`` keeps the first period of each run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            counts, lists, collapsed = _scan(piece.column("text"))
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(counts), lists, collapsed], ["doc_id", "n_words", "runs", "collapsed"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_words long, runs {RUNS}, collapsed string")


def collapse(documents: DataFrame) -> DataFrame:
    """All rows and columns; a text that holds a run becomes its collapsed text, other texts stay as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            text = piece.column("text")
            _, lists, collapsed = _scan(text)
            some = pa.array(np.diff(lists.offsets.to_numpy()) > 0)
            at = piece.schema.get_field_index("text")
            yield piece.set_column(at, piece.schema.field(at), pc.if_else(some, collapsed.cast(text.type), text))

    return documents.mapInArrow(run, documents.schema)


WORD = r"[^\x20\x09-\x0D]+"


def with_periods(documents: DataFrame) -> DataFrame:
    """(doc_id, text) where the words of about a tenth of the texts repeat from some place on.

    With h = crc32 of the id and g = floor(h / 10): if h is divisible by 10, word i >= a = g % n becomes word
    a + (i - a) % p, p = 1 + floor((n - a) / (3 + g % 8)). Rows with a null id stay as they are.
    """
    h = "crc32(cast(doc_id as string))"
    # The words are the argument of a lambda, so that they are taken from a text once.
    changed = f"""transform(array(regexp_extract_all(text, '{WORD.replace(chr(92), chr(92) * 2)}', 0)), w -> CASE WHEN size(w) = 0 THEN text ELSE
      array_join(transform(sequence(0, size(w) - 1), i -> w[cast(IF(i >= g % size(w),
        g % size(w) + (i - g % size(w)) % (1 + (size(w) - g % size(w)) div (3 + g % 8)), i) as int)]), ' ') END)[0]"""
    return documents.selectExpr("doc_id", "text", f"{h} div 10 as g", f"{h} % 10 = 0 as hit").selectExpr("doc_id", f"CASE WHEN hit AND text IS NOT NULL THEN {changed} ELSE text END as text")


def digest(found: DataFrame) -> DataFrame:
    """The runs and collapsed texts of ``find_runs`` as counts, the strongest run and digests."""
    best = F.expr("array_max(transform(runs, r -> struct(r.length / r.period as power, -r.start as start, -r.period as period, r.length as length)))")
    listed = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), listed.alias("listed"), "collapsed", "n_words").selectExpr(
        "doc_id",
        "n_runs",
        "-best.start as start",
        "best.length as length",
        "-best.period as period",
        "1000 * best.length div -best.period as exponent_milli",
        "sha2(listed, 256) as runs_sha256",
        "sha2(collapsed, 256) as collapsed_sha256",
        "n_words",
    )
