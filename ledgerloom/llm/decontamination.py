"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment of words.

The test items are the stated query set. They are taken in blocks of bounded size, and a block's n-grams are sent to
every task. Every n-gram of an item is a seed, however frequent, since a part that is enough for the threshold may
consist of frequent ones only. The seeds are found in whole texts, and the item is aligned with the stretch of words
around each seed hit, unless the stretch holds so few of the item's words that no alignment can reach the threshold.
The score of an alignment (match 2, mismatch and gap -1) is divided by that of the item with itself.

Words are runs of letters, digits, apostrophes and bytes above 127, lower case. Nothing is shuffled but counts, so
hot sources, copies and passages need no care.

Defined results: null or empty texts match nothing; an item with fewer than ``SEED_WORDS`` words has no seed and
matches nothing; rows that repeat a document or an item give repeated pairs once for each document row and item id
(the best score); rows with a null id are searched like others; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.text import IS_BREAK, pieces, shingles, utf8, word_hashes, words

SEED_WORDS = 3
THRESHOLD = 0.5
#: Bytes of item texts in a block; blocks are searched one after the other.
BLOCK_BYTES = 4 << 20
MATCH, MISS = 2, 1
ALIGN_ROWS = 512
#: Places where an item may lie in a text, looked at together.
SPOTS = 1 << 18


@dataclass
class Block:
    """Items of a block: ids, word hashes with bounds, and each n-gram with the places where it stands."""

    ids: list
    words: np.ndarray
    bounds: np.ndarray
    grams: np.ndarray
    gram_of: np.ndarray
    item_of: np.ndarray
    place_of: np.ndarray


@dataclass
class Seeds:
    grams: np.ndarray
    first: np.ndarray
    item: np.ndarray
    place: np.ndarray
    may: np.ndarray


def _hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    found = words(*utf8(column), separators=IS_BREAK)
    return word_hashes(found), found.bounds


def _grams(h: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all n-grams, the text of each and its first word."""
    counts = np.diff(bounds)
    long = np.flatnonzero(counts >= SEED_WORDS)
    g, edges = shingles(h, bounds, SEED_WORDS)
    sizes = np.diff(edges)
    text = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(g)) - edges[:-1][text]
    whole = np.zeros(len(sizes), bool)
    whole[long] = True
    keep = whole[text]
    return g[keep], text[keep], place[keep]


def _bits(grams: np.ndarray) -> np.ndarray:
    may = np.zeros(1 << 20, bool)
    may[(grams & np.uint64(len(may) - 1)).astype(np.int64)] = True
    return may


def _find(grams: np.ndarray, may: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``g`` of known n-grams, and which they are."""
    if not len(grams):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    near = np.flatnonzero(may[(g & np.uint64(len(may) - 1)).astype(np.int64)])
    at = np.minimum(np.searchsorted(grams, g[near]), len(grams) - 1)
    same = grams[at] == g[near]
    return near[same], at[same]


def item_blocks(items: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """Blocks of items, dealt by a hash of the id; a block is as large as ``block_bytes`` says, on average."""
    items = items.where("item_id is not null and text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    for k in range(blocks if size else 0):
        got = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k).select("item_id", "text").dropDuplicates().orderBy("item_id", "text").toArrow().combine_chunks()
        if not got.num_rows:
            continue
        h, bounds = _hashes(got.column("text").combine_chunks())
        g, item, place = _grams(h, bounds)
        grams, gram_of = np.unique(g, return_inverse=True)
        yield Block(got.column("item_id").to_pylist(), h, bounds, grams, gram_of, item, place)


def seeds_of(block: Block) -> Seeds:
    """Every n-gram of the block's items, with the places where it stands."""
    chosen = np.argsort(block.gram_of, kind="stable")
    first = np.searchsorted(block.gram_of[chosen], np.arange(len(block.grams) + 1))
    return Seeds(block.grams, first, block.item_of[chosen], block.place_of[chosen], _bits(block.grams))


def align(items: np.ndarray, sizes: np.ndarray, stretches: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smith-Waterman of each row's item with its stretch: best score and the column where it ends.

    ``items`` and ``stretches`` hold word hashes; zeros pad both and match nothing.
    """
    rows, width = stretches.shape
    slope = np.arange(width, dtype=np.int32)[None]
    above = np.zeros((rows, width + 1), np.int32)
    best, end = np.zeros(rows, np.int32), np.zeros(rows, np.int64)
    for i in range(int(sizes.max(initial=0))):
        word = items[:, i : i + 1]
        step = np.where((stretches == word) & (word != 0), MATCH, -MISS).astype(np.int32)
        here = np.maximum(np.maximum(above[:, :-1] + step, above[:, 1:] - MISS), 0)
        here = np.maximum.accumulate(here + slope * MISS, axis=1) - slope * MISS
        above[:, 1:] = here
        top = here.argmax(1)
        value = here[np.arange(rows), top]
        better = value > best
        best, end = np.where(better, value, best), np.where(better, top, end)
    return best, end


def _spots(text: np.ndarray, place: np.ndarray, which: np.ndarray, block: Block, seeds: Seeds) -> np.ndarray:
    """Distinct (text, item, slot) of the seed hits; a slot is a quarter of the item long."""
    times = seeds.first[which + 1] - seeds.first[which]
    upto = np.cumsum(times)
    found, at = [np.zeros((3, 0), np.int64)], 0
    while at < len(which):  # so many hits at once that memory doesn't follow how many items share an n-gram
        end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + SPOTS, "right")))
        n = times[at:end]
        owner = np.repeat(np.arange(at, end), n)
        entry = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(seeds.first[which[at:end]], n)
        item = seeds.item[entry]
        pad = np.maximum(4, np.diff(block.bounds)[item] // 4)
        found.append(np.unique(np.stack([text[owner], item, np.floor_divide(place[owner] - seeds.place[entry], pad)]), axis=1))
        at = end
    return np.unique(np.concatenate(found, 1), axis=1)


def _can_reach(h: np.ndarray, start: np.ndarray, width: np.ndarray, item: np.ndarray, block: Block, threshold: float) -> np.ndarray:
    """Whether the stretch of a spot holds so many of its item's words that an alignment can reach the threshold.

    Every match needs a word of the item that the stretch holds, and is worth as much as in the item itself.
    """
    size = np.diff(block.bounds)[item]
    out, at, upto = np.zeros(len(item), bool), 0, np.cumsum(width + size)
    while at < len(item):
        end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + 16 * SPOTS, "right")))
        turn = (np.arange(end - at).astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)  # words of different spots differ

        def keys(words: np.ndarray, first: np.ndarray, n: np.ndarray, turn: np.ndarray = turn) -> np.ndarray:
            return words[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)] + np.repeat(turn, n)

        asked = keys(block.words, block.bounds[:-1][item[at:end]], size[at:end])
        held = np.isin(asked, keys(h, start[at:end], width[at:end]))
        common = np.bincount(np.repeat(np.arange(end - at), size[at:end]), held, end - at)
        out[at:end] = common / size[at:end] >= threshold
        at = end
    return out


def _search(column: pa.Array, block: Block, seeds: Seeds, threshold: float) -> tuple[np.ndarray, ...]:
    """(text, item, score, first word, word past the end) of the best passage of each pair at the threshold."""
    h, bounds = _hashes(column)
    g, text, place = _grams(h, bounds)
    where, which = _find(seeds.grams, seeds.may, g)
    doc, item, slot = _spots(text[where], place[where], which, block, seeds)
    size = np.diff(block.bounds)[item]
    pad = np.maximum(4, size // 4)
    counts = np.diff(bounds)[doc]
    low = np.clip(slot * pad - pad, 0, counts)
    high = np.clip(slot * pad + 2 * pad + size, 0, counts)
    may = _can_reach(h, bounds[doc] + low, high - low, item, block, threshold)
    doc, item, low, high, size = (v[may] for v in (doc, item, low, high, size))
    scores, ends = np.zeros(len(doc)), np.zeros(len(doc), np.int64)
    padded, known = np.append(h, np.uint64(0)), np.append(block.words, np.uint64(0))
    order = np.argsort(size, kind="stable")
    for at in range(0, len(order), ALIGN_ROWS):
        pick = order[at : at + ALIGN_ROWS]
        wide, tall = np.arange((high - low)[pick].max()), np.arange(size[pick].max())
        stretch = padded[np.where(wide < (high - low)[pick, None], bounds[doc[pick], None] + low[pick, None] + wide, len(h))]
        rows = known[np.where(tall < size[pick, None], block.bounds[item[pick], None] + tall, len(block.words))]
        best, end = align(rows, size[pick], stretch)
        scores[pick], ends[pick] = best / (MATCH * size[pick]), low[pick] + end + 1
    good = np.flatnonzero(scores >= threshold)
    good = good[np.lexsort((ends[good], -scores[good], item[good], doc[good]))]
    first = np.ones(len(good), bool)
    first[1:] = (doc[good][1:] != doc[good][:-1]) | (item[good][1:] != item[good][:-1])
    good = good[first]
    return doc[good], item[good], scores[good], low[good], ends[good]


def contaminated(documents: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, score, first_word, end_word) of every pair whose alignment reaches the threshold."""
    kinds = [documents.schema["doc_id"].dataType, items.schema["item_id"].dataType]
    schema = f"doc_id {kinds[0].simpleString()}, item_id {kinds[1].simpleString()}, score double, first_word long, end_word long"
    out = documents.sparkSession.createDataFrame([], schema)
    for block in item_blocks(items):
        seeds = seeds_of(block)
        ids = pa.array(block.ids)

        def run(batches: Iterator[pa.RecordBatch], block: Block = block, seeds: Seeds = seeds, ids: pa.Array = ids) -> Iterator[pa.RecordBatch]:
            for piece in pieces(batches):
                doc, item, score, low, end = _search(piece.column("text"), block, seeds, threshold)
                if len(doc):
                    columns = [piece.column("doc_id").take(pa.array(doc)), ids.take(pa.array(item)), *map(pa.array, (score, low, end))]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "score", "first_word", "end_word"])

        out = out.unionByName(documents.select("doc_id", "text").mapInArrow(run, schema))
    return out


def decontaminate(documents: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows that hold no passage of an item, with all their columns."""
    for block in item_blocks(items):
        seeds = seeds_of(block)

        def run(batches: Iterator[pa.RecordBatch], block: Block = block, seeds: Seeds = seeds) -> Iterator[pa.RecordBatch]:
            for piece in pieces(batches):
                keep = np.ones(piece.num_rows, bool)
                keep[_search(piece.column("text"), block, seeds, threshold)[0]] = False
                yield piece.filter(pa.array(keep))

        documents = documents.mapInArrow(run, documents.schema)
    return documents
